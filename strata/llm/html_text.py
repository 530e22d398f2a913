"""Operator 9: main-text extraction from flat text blocks by a decision tree.

A page is cut at block-level tags into a flat list of text blocks.  A block's
features are its own word count and link density and those of its two
neighbours in the same region, where it stands (inside the article, outside it, or on a page that
marks none; the surest mark counts), and whether it is inside an element named for page furniture or a
heading.  A small labelled table trains a decision tree, which keeps or drops each
block; kept blocks are joined in page order.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# Element names by what they do to the text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split())
UNSEEN_TAGS = frozenset(
    "applet audio canvas embed head iframe math noembed noframes noscript object script select style svg template "
    "textarea title video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_TAGS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Elements whose end tag may be left out: which open ones a start tag ends, and which open ones it does not look beyond.
ENDS_PARAGRAPH = BLOCK_TAGS - frozenset("body caption frameset html legend optgroup option tbody td tfoot th thead tr".split())
_BEYOND_PARAGRAPH = UNSEEN_TAGS | frozenset("button caption html table td th".split())
_BEYOND_ITEM = UNSEEN_TAGS | BLOCK_TAGS - frozenset("address dd div dt li p".split())
_BEYOND_CELL = UNSEEN_TAGS | frozenset(["table"])
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), _BEYOND_ITEM), **dict.fromkeys(("dd", "dt"), (frozenset(["dd", "dt"]), _BEYOND_ITEM)),
    **dict.fromkeys(("td", "th"), (frozenset(["caption", "td", "th"]), _BEYOND_CELL | {"tr"})),
    "tr": (frozenset(["caption", "td", "th", "tr"]), _BEYOND_CELL),
    **dict.fromkeys(("tbody", "tfoot", "thead"), (frozenset("caption tbody td tfoot th thead tr".split()), _BEYOND_CELL)),
}
FURNITURE_TAGS = frozenset("aside button dialog footer form menu nav search".split())
ARTICLE_TAGS = frozenset("article main".split())
FURNITURE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
FURNITURE_NAMES = frozenset(
    "ad adbox ads adsense adslot adunit advert advertisement advertising adverts alert announcement banner breadcrumb "
    "breadcrumbs captcha comment commentlist comments consent cookie cookies copyright discussion disqus disclaimer "
    "feedback footer footnav form gdpr header hidden login logo mainmenu mainnav masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification overlay pageheader pager pagination paywall popup promo promoted "
    "promotion rail recommended related replies reply respond rss search share sharing sidebar sidenav signin signup "
    "siteheader sitenav skip social sponsor sponsored subscribe subscription toolbar topbar topnav widget widgets".split())
#: What a class or id of several words says by its first or last one ("ad-slot", "post-footer").
PART_NAMES = FURNITURE_NAMES - frozenset(
    "advertising alert announcement copyright discussion disclaimer feedback form header hidden navigation notice notices promotion "
    "rail search share skip social".split())
#: What an id may as well say as the title of a part of the article.
TITLE_NAMES = (FURNITURE_NAMES - PART_NAMES - {"header", "hidden", "rail", "skip"}) | frozenset(
    "advertisement comment consent newsletter notification paywall recommended related replies reply respond sharing sponsor subscription".split())
ARTICLE_NAMES = frozenset("article articlebody content entry main maincontent post postbody story storybody".split())
#: From such a word on, a class says what a page has, not what the element is.
SAYS_ABOUT = frozenset("has is no not with without".split())

# The labelled table.  words and link density of the block before, the block itself and the block after;
# place (2 inside the article, 0 outside it, 1 where the page marks no article); inside furniture (0.5 what may be); a heading; kept.
LABELLED = [
    # inside the article blocks are kept, long or short, unless they stand in furniture
    (6, 0.0, 9, 0.0, 60, 0.0, 2, 0, 1, 1), (9, 0.0, 60, 0.0, 80, 0.0, 2, 0, 0, 1),
    (60, 0.0, 80, 0.0, 1, 0.0, 2, 0, 0, 1), (80, 0.0, 1, 0.0, 45, 0.0, 2, 0, 0, 1),
    (1, 0.0, 45, 0.1, 7, 0.0, 2, 0, 0, 1), (45, 0.1, 7, 0.0, 9, 0.0, 2, 0, 0, 1),
    (3, 0.0, 2, 0.0, 2, 0.0, 2, 0, 0, 1), (2, 0.0, 2, 1.0, 30, 0.0, 2, 0, 0, 1),
    (0, 0.0, 4, 0.0, 0, 0.0, 2, 0, 1, 1), (0, 0.0, 1, 0.0, 1, 0.0, 2, 0, 0, 1),
    (30, 0.0, 3, 0.0, 5, 1.0, 2, 0, 0, 1), (150, 0.0, 200, 0.2, 90, 0.0, 2, 0, 0, 1),
    (60, 0.0, 8, 0.0, 70, 0.0, 2, 1, 0, 0), (70, 0.0, 40, 0.0, 12, 0.0, 2, 1, 0, 0),
    (40, 0.0, 120, 0.0, 6, 0.0, 2, 1, 0, 0), (50, 0.0, 3, 1.0, 3, 1.0, 2, 1, 0, 0),
    (9, 0.0, 2, 0.0, 40, 0.0, 2, 1, 1, 0), (20, 0.0, 25, 0.0, 30, 0.0, 2, 1, 0, 0),
    (18, 0.0, 60, 0.0, 70, 0.0, 2, 0, 0, 1), (22, 0.0, 5, 0.0, 3, 0.0, 2, 0, 0, 1),
    (24, 0.0, 1, 0.0, 20, 0.0, 2, 0, 0, 1), (20, 0.3, 12, 0.0, 2, 1.0, 2, 0, 0, 1),
    (2, 1.0, 14, 0.0, 8, 1.0, 2, 0, 0, 1), (90, 0.0, 6, 0.0, 0, 0.0, 2, 0, 0, 1),
    (75, 0.0, 9, 0.2, 5, 1.0, 2, 0, 0, 1), (1, 1.0, 3, 0.0, 4, 1.0, 2, 0, 0, 1),
    (0, 0.0, 30, 0.9, 2, 0.0, 2, 0, 0, 1), (300, 0.0, 2, 0.0, 300, 0.0, 2, 0, 0, 1),
    (40, 0.0, 250, 0.0, 10, 0.0, 2, 0, 0, 1), (5, 1.0, 6, 0.8, 7, 1.0, 2, 0, 0, 1),
    (16, 0.0, 24, 0.0, 18, 0.0, 2, 0, 0, 1), (10, 0.0, 10, 0.0, 10, 0.0, 2, 0, 0, 1),
    # what a page puts outside its article is dropped
    (0, 0.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 7, 0.0, 9, 0.0, 0, 1, 0, 0),
    (40, 0.0, 9, 0.0, 0, 0.0, 0, 1, 0, 0), (1, 1.0, 7, 0.0, 9, 0.0, 0, 0, 0, 0),
    (90, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0), (90, 0.0, 5, 1.0, 6, 1.0, 0, 0, 0, 0),
    (4, 1.0, 60, 0.0, 12, 0.0, 0, 0, 0, 0), (60, 0.0, 120, 0.0, 70, 0.0, 0, 1, 0, 0),
    (2, 1.0, 6, 0.0, 8, 0.0, 0, 0, 1, 0), (80, 0.0, 100, 0.05, 60, 0.0, 0, 0, 0, 0),
    (20, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 0), (12, 0.0, 20, 0.0, 300, 0.0, 0, 0, 0, 0),
    (300, 0.0, 15, 0.0, 0, 0.0, 0, 0, 0, 0), (0, 0.0, 25, 0.0, 18, 0.0, 0, 0, 0, 0),
    (60, 0.0, 75, 0.0, 3, 1.0, 0, 0, 0, 0), (24, 0.0, 60, 0.1, 24, 0.0, 0, 0, 0, 0),
    (8, 0.0, 1, 0.0, 10, 0.0, 0, 0, 0, 0),
    # pages that mark no article: word counts and link densities decide, outside furniture
    (5, 0.0, 40, 0.0, 50, 0.0, 1, 0, 0, 1), (40, 0.0, 50, 0.1, 60, 0.0, 1, 0, 0, 1),
    (50, 0.1, 90, 0.0, 5, 0.0, 1, 0, 0, 1), (60, 0.0, 12, 0.0, 70, 0.0, 1, 0, 0, 1),
    (70, 0.0, 6, 0.0, 80, 0.0, 1, 0, 0, 1), (12, 0.0, 25, 0.0, 4, 0.0, 1, 0, 0, 1),
    (6, 0.0, 30, 0.2, 30, 0.1, 1, 0, 0, 1), (1, 1.0, 35, 0.0, 50, 0.0, 1, 0, 0, 1),
    (0, 0.0, 22, 0.0, 0, 0.0, 1, 0, 0, 1), (50, 0.0, 3, 0.0, 60, 0.0, 1, 0, 0, 1),
    (30, 0.0, 1, 0.0, 45, 0.0, 1, 0, 0, 1), (0, 0.0, 130, 0.0, 0, 0.0, 1, 0, 0, 1),
    (2, 1.0, 8, 0.0, 60, 0.0, 1, 0, 1, 1), (0, 0.0, 5, 0.0, 40, 0.0, 1, 0, 1, 1),
    (60, 0.0, 4, 0.0, 50, 0.0, 1, 0, 1, 1), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (1, 1.0, 2, 1.0, 40, 0.0, 1, 0, 0, 0), (50, 0.0, 4, 1.0, 5, 1.0, 1, 0, 0, 0),
    (5, 1.0, 20, 0.9, 6, 1.0, 1, 0, 0, 0), (6, 1.0, 8, 0.5, 3, 1.0, 1, 0, 0, 0),
    (3, 1.0, 5, 0.0, 2, 1.0, 1, 0, 0, 0), (2, 1.0, 3, 0.0, 4, 0.0, 1, 0, 0, 0),
    (40, 0.0, 7, 0.0, 0, 0.0, 1, 0, 0, 0), (4, 0.0, 6, 0.0, 5, 1.0, 1, 0, 0, 0),
    (3, 1.0, 4, 0.0, 3, 1.0, 1, 0, 1, 0), (0, 0.0, 5, 0.0, 4, 1.0, 1, 0, 0, 0),
    (60, 0.0, 45, 0.8, 5, 1.0, 1, 0, 0, 0), (50, 0.0, 40, 0.0, 45, 0.0, 1, 1, 0, 0),
    (5, 1.0, 12, 0.0, 60, 0.0, 1, 1, 0, 0), (60, 0.0, 30, 0.0, 20, 0.0, 1, 1, 0, 0),
    (60, 0.0, 3, 0.0, 50, 0.0, 1, 1, 1, 0), (30, 0.0, 90, 0.0, 70, 0.0, 1, 1, 0, 0),
    (45, 0.0, 6, 0.15, 0, 0.0, 1, 0, 0, 0), (80, 0.0, 9, 0.0, 0, 0.0, 1, 0, 0, 0),
    (30, 0.0, 5, 0.3, 0, 0.0, 1, 0, 0, 0), (2, 1.0, 7, 0.0, 3, 1.0, 1, 0, 0, 0),
    (4, 0.0, 3, 0.0, 5, 0.0, 1, 0, 0, 0), (0, 0.0, 4, 0.0, 3, 1.0, 1, 0, 0, 0), (8, 0.0, 9, 0.0, 7, 1.0, 1, 0, 0, 0),
    (6, 1.0, 30, 0.85, 40, 0.0, 1, 0, 0, 0), (25, 0.0, 20, 0.0, 18, 0.0, 1, 0, 0, 1),
    (18, 0.0, 60, 0.0, 22, 0.0, 1, 0, 0, 1), (22, 0.0, 16, 0.1, 90, 0.0, 1, 0, 0, 1),
    (90, 0.0, 30, 0.0, 0, 0.0, 1, 0, 0, 1), (80, 0.0, 60, 0.3, 3, 1.0, 1, 0, 0, 1),
    (20, 0.0, 4, 0.0, 24, 0.0, 1, 0, 0, 1), (35, 0.0, 8, 0.0, 40, 0.0, 1, 0, 0, 1),
    (120, 0.0, 2, 0.0, 90, 0.0, 1, 0, 0, 1), (3, 1.0, 28, 0.0, 4, 1.0, 1, 0, 0, 1),
    (16, 0.0, 200, 0.0, 16, 0.0, 1, 0, 0, 1),
    (0, 0.0, 8, 0.0, 0, 0.0, 1, 0, 0, 1), (0, 0.0, 3, 0.0, 0, 0.0, 1, 0, 0, 1), (0, 0.0, 14, 0.1, 0, 0.0, 1, 0, 0, 1),
]


def _label(before: tuple, own: tuple, after: tuple, place: int, furniture: float, heading: int) -> int:
    """Kept or not, for the rows of the table that go over all combinations."""
    (wb, lb), (words, links), (wa, la) = before, own, after
    if furniture == 1 or place == 0:
        return 0
    if furniture:                                # in what may be furniture: paragraphs, and what stands next to one
        long = 12 if place == 2 else 20
        return int(links <= 0.3 and (words >= long or (wb >= long and lb <= 0.3) or (wa >= (3 if heading else long) and la <= 0.3)))
    if place == 2:                               # neighbours, length and links drop nothing inside the article
        return 1
    if links > 0.5:                              # a list of links
        return 0
    if words >= 10:                              # a paragraph, with a few links or many
        return 1
    text_after = wa >= 6 and la <= 0.5
    if links <= 0.1:                             # a short line: before text, alone, or among other short lines at the top
        return int(text_after or (wa < 6 and la <= 0.5 and wb <= 3 and lb <= 0.5))
    return int(0.05 <= la <= 0.5)


def _rows(before: tuple, after: tuple, words: tuple, links: tuple, furniture: tuple) -> list[tuple]:
    """Rows for all combinations of what is given, in every place, heading or not."""
    return [(*b, *own, *a, place, f, heading, _label(b, own, a, place, f, heading))
            for b in before for a in after for own in itertools.product(words, links)
            for place in (0, 1, 2) for f in furniture for heading in (0, 1)]


# The table's other rows: every combination, so that no block falls where no row decides.
LABELLED += _rows(((0, 0.0), (3, 0.0), (3, 0.5), (4, 0.0), (4, 0.6), (60, 0.0), (60, 1.0)),
                  ((0, 0.0), (5, 0.0), (5, 0.05), (5, 0.3), (5, 0.6), (6, 0.0), (6, 0.5), (6, 0.6), (60, 0.0), (60, 0.3), (60, 1.0)),
                  (1, 9, 10, 300), (0.0, 0.1, 0.15, 0.5, 0.6, 1.0), (0, 1))
LABELLED += _rows(((0, 0.0), (11, 0.0), (12, 0.0), (19, 0.0), (20, 0.3), (60, 0.4)),
                  ((0, 0.0), (2, 0.0), (3, 0.0), (11, 0.0), (12, 0.0), (19, 0.0), (20, 0.3), (60, 0.4)),
                  (1, 11, 12, 19, 20, 300), (0.0, 0.3, 0.4, 1.0), (0.5,))


#: Words of a block that is surely a paragraph, in weighing marks against each other.
PARAGRAPH = 20


@dataclass
class Node:
    """A cut (``feature`` below ``cut`` goes to ``low``) or, without one, a leaf."""
    keep: bool
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def train(rows: list[tuple] = LABELLED, at_least: int = 1) -> Node:
    """A decision tree by Gini impurity; ties go to the first feature and lowest cut."""
    x, y = np.array([r[:-1] for r in rows], float), np.array([r[-1] for r in rows])

    def impurity(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 2 * ones * (n - ones) / n

    def grow(at: np.ndarray) -> Node:
        leaf = Node(bool(2 * y[at].sum() >= len(at)))
        if y[at].min() == y[at].max():
            return leaf
        best = (impurity(y[at].sum(), len(at)) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            order = at[np.argsort(x[at, f], kind="stable")]
            v, ones = x[order, f], np.cumsum(y[order])[:-1]
            n = np.arange(1, len(order))
            cost = impurity(ones, n) + impurity(ones[-1] + y[order[-1]] - ones, len(order) - n)
            cost[(v[1:] == v[:-1]) | (n < at_least) | (len(order) - n < at_least)] = np.inf
            i = int(cost.argmin())
            if cost[i] < best[0]:
                best = cost[i], f, (v[i] + v[i + 1]) / 2
        if best[1] < 0:
            return leaf
        low = x[at, best[1]] < best[2]
        return Node(leaf.keep, best[1], best[2], grow(at[low]), grow(at[~low]))

    return grow(np.arange(len(rows)))


def kept(node: Node, features: tuple) -> bool:
    while node.low is not None:
        node = node.low if features[node.feature] < node.cut else node.high
    return node.keep


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    marks: frozenset[int]       # the marks of an article it stands in
    furniture: float            # 1 in furniture, 0.5 in what may be furniture, else 0
    heading: bool


_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PREFORMATTED_SPACE = re.compile(r"\s+")


#: How sure a mark of the article is; the surest one on a page counts.
NAMED, MAIN, ARTICLE = 1, 2, 3


def _names_furniture(names: list[str], name: str, key: str, inside: int) -> float:
    """How far the words of a class or id name furniture: 1 as a whole or by the
    first or last one; 0.5 by another, or where the id may be a title; else 0."""
    heading = name[0] == "h" and name[1:].isdigit()
    if heading and key == "id":                  # a link target made of the heading's own words
        return 0
    if names[-1] == "header" and (heading or inside and (len(names) == 1 or names[0] in ARTICLE_NAMES)):
        return 0                                 # the article's own, like <header> inside it
    said = [w in FURNITURE_NAMES for w in names if not w.isdigit()]
    if said and all(said) or "".join(names) in FURNITURE_NAMES:
        return 0.5 if key == "id" and len(said) == 1 and names[0] in TITLE_NAMES else 1
    if not any(said):
        return 0
    parts = PART_NAMES if key == "class" else PART_NAMES - TITLE_NAMES if name != "section" else ()
    return 1 if names[0] in parts or names[-1] in parts else 0.5


def _kind(name: str, rest: str, inside: int) -> tuple[str, int]:
    """What an element's own tag says: 'unseen', 'furniture', 'doubtful' (it may
    be furniture) or '', and the mark of an article (0 if none).  ``inside`` is
    the mark it stands in."""
    if name in UNSEEN_TAGS:
        return "unseen", 0
    mark = ARTICLE if name == "article" else MAIN if name == "main" else 0
    furniture = float(name in FURNITURE_TAGS or (name == "header" and not inside))
    if rest.strip(" /\t\r\n"):
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), unescape(value.strip("\"'"))
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDDEN.search(value)):
                return "unseen", 0
            if key == "role":
                furniture = max(furniture, float(value.lower() in FURNITURE_ROLES))
                mark = max(mark, {"article": ARTICLE, "main": MAIN}.get(value.lower(), 0))
            elif key in ("class", "id") and name not in ("html", "body"):
                for part in value.split():
                    names = _NAME.findall(_CAMEL.sub(" ", part).lower())
                    if name in ARTICLE_TAGS:       # an article that is a reader's comment, or an advert, says so in a word
                        furniture = max(furniture, float(part.lower() in FURNITURE_NAMES))
                        continue
                    names = list(itertools.takewhile(lambda w: w not in SAYS_ABOUT, names))
                    if names:
                        furniture = max(furniture, _names_furniture(names, name, key, inside))
                        if len(names) <= 2 and (not ARTICLE_NAMES.isdisjoint(names) or "".join(names) in ARTICLE_NAMES):
                            mark = max(mark, NAMED)
    return ("furniture", 0) if furniture == 1 else ("doubtful", 0) if furniture else ("", mark)


def blocks(html: str) -> list[Block]:
    """The flat text blocks of a page: character references decoded, white
    space (and ``<br>``) turned into one space, empty blocks left out."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0                                  # words inside links of the open block
    stack: list[tuple[str, str, int]] = []      # open elements that hold blocks or say something: name, kind, mark
    depth = {"unseen": 0, "furniture": 0, "doubtful": 0, "": 0}
    marks = {0: 0, NAMED: 0, MAIN: 0, ARTICLE: 0}
    link_from, heading, article_seen = -1, False, False
    paragraphs = 0                              # open ones

    def close_link() -> None:
        nonlocal linked, link_from
        if link_from >= 0:
            linked += len("".join(parts[link_from:]).split())
            link_from = -1

    def close(i: int) -> None:
        nonlocal paragraphs
        for tag, k, mark in stack[i:]:
            depth[k] -= 1
            marks[mark] -= 1
            paragraphs -= tag == "p"
        del stack[i:]

    def close_implied(name: str) -> None:
        """Ends the open elements without an end tag that a start tag ends."""
        if stack and stack[-1][0] == "head" and name not in HEAD_TAGS:
            close(len(stack) - 1)
        elif name == "body" and depth["unseen"]:
            heads = [i for i, (tag, *_) in enumerate(stack) if tag == "head"]
            if heads:
                close(heads[0])
        if paragraphs and name in ENDS_PARAGRAPH:
            for i in range(len(stack) - 1, -1, -1):
                tag, _, mark = stack[i]
                if tag == "p":
                    if not mark or name == "p" and i == len(stack) - 1:   # a paragraph named for the article holds what follows
                        close(i)
                    break
                if tag in _BEYOND_PARAGRAPH:
                    break
        if name in IMPLIED_ENDS:
            names, beyond = IMPLIED_ENDS[name]
            first = -1
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    first = i
                elif stack[i][0] in beyond:
                    break
            if first >= 0:
                close(first)

    def end_block() -> None:
        nonlocal linked, link_from
        open_link = link_from >= 0
        close_link()
        text = " ".join("".join(parts).split())
        if text:
            n = text.count(" ") + 1
            out.append(Block(text, n, min(1.0, linked / n), frozenset(m for m in (NAMED, MAIN, ARTICLE) if marks[m]),
                             1 if depth["furniture"] else 0.5 if depth["doubtful"] else 0, heading))
        parts.clear()
        linked, link_from = 0, 0 if open_link else -1

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        text, name = m["text"], m["name"]
        if text is not None:
            if stack and stack[-1][0] == "head" and not text.isspace():
                close(len(stack) - 1)
            if not depth["unseen"]:
                parts.append(unescape(text) if "&" in text else text)
            continue
        if name is None:
            continue
        name = name.lower()
        if m["end"]:
            if name == "a":
                close_link()
            if name in BLOCK_TAGS and not depth["unseen"]:
                end_block()
                if name[0] == "h" and name[1:].isdigit():
                    heading = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if name == "p" and stack[i][0] in BLOCK_TAGS:    # its paragraph has ended already
                    break
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK_TAGS and not depth["unseen"]:
            end_block()
        close_implied(name)
        if name in ("script", "style", "textarea", "title", "iframe", "noembed", "noframes"):
            found = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)   # raw text up to its end tag
            at = found.end() if found else n
            continue
        if name in BLOCK_TAGS and not depth["unseen"]:
            heading = name[0] == "h" and name[1:].isdigit()
        if name == "a":
            close_link()
            link_from = len(parts)
        if name in VOID_TAGS or m["rest"].endswith("/") and name not in BLOCK_TAGS:
            continue
        kind, mark = _kind(name, m["rest"], max(k for k, n_open in marks.items() if n_open or not k))
        if mark >= MAIN and not article_seen:    # the page's article is no furniture, whatever it is wrapped in
            article_seen = mark == ARTICLE
            for i, (tag, k, its_mark) in enumerate(stack):
                if k in ("furniture", "doubtful"):
                    depth[k] -= 1
                    depth[""] += 1
                    stack[i] = tag, "", its_mark
        if kind or mark or name in BLOCK_TAGS:
            stack.append((name, kind, mark))
            depth[kind] += 1
            marks[mark] += 1
            paragraphs += name == "p"
    end_block()
    return out


def _region_mark(flat: list[Block]) -> tuple[int, set[int]]:
    """The surest mark on the page, and the surer ones that were passed over: those that only
    mark cards or teasers, beside which the next mark holds paragraphs of twice their words."""
    marks = sorted({m for b in flat for m in b.marks if not b.furniture or b.furniture < 1 and m >= MAIN}, reverse=True)
    cards: set[int] = set()
    for mark, wider in zip(marks, marks[1:]):
        inside = sum(b.words for b in flat if mark in b.marks and b.furniture != 1)
        paragraphs = sum(b.words for b in flat if wider in b.marks and mark not in b.marks and not b.furniture
                         and b.words >= PARAGRAPH and b.link_density <= 0.3)
        if paragraphs < 2 * max(1, inside):
            return mark, cards
        cards.add(mark)
    return (marks[-1] if marks else 0), cards


def features(flat: list[Block]) -> list[tuple]:
    """The features of each block, in the order of the labelled table.  A block's
    neighbours are the nearest of its own region: of one place, in furniture or not."""
    mark, cards = _region_mark(flat)
    region = [(1 if not mark else 2 if mark in b.marks and not cards & set(b.marks) else 0, b.furniture) for b in flat]

    def beside(order: range) -> dict[int, tuple[int, float]]:
        last: dict[tuple, tuple[int, float]] = {}
        found = {}
        for i in order:
            found[i] = last.get(region[i], (0, 0.0))
            last[region[i]] = flat[i].words, flat[i].link_density
        return found

    before, after = beside(range(len(flat))), beside(range(len(flat) - 1, -1, -1))
    return [(*before[i], b.words, b.link_density, *after[i], *region[i], int(b.heading)) for i, b in enumerate(flat)]


def main_text(html: str, tree: Node) -> str:
    flat = blocks(html)
    return "\n".join(b.text for b, f in zip(flat, features(flat)) if kept(tree, f))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            labelled: list[tuple] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``: the main text
    of the whole html, empty if there is none, and its code points.

    Null and empty html give an empty text.  Repeated rows and null ids and urls
    give a row each.  An empty table gives an empty result; extra columns are
    not read.  A narrow map over the scan; the tree (a few dozen nodes, trained
    on ``labelled``) goes along with the tasks.
    """
    tree = train(labelled or LABELLED)

    def run(batch: dict) -> dict:
        text = [main_text(h, tree) for h in batch["html"]]
        return {id_col: batch["id"], url_col: batch["url"], "text": text, "n_chars": list(map(len, text))}

    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return map_rows(src, run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
