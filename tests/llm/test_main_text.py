"""Operator 9: what the tree, the parser and the names of elements must not lose."""

import itertools

import pytest

from strata.llm import html_text

LONG = ("a long paragraph of the story " * 50).strip()


def text(page):
    return html_text.main_text(page, html_text.train())


def test_tree_keeps_every_block_of_the_article():
    tree = html_text.train()
    beside = list(itertools.product((0, 1, 3, 5, 9, 16, 60, 400), (0.0, 0.04, 0.2, 0.5, 0.6, 1.0)))
    for before, after in itertools.product(beside, beside):
        for words, links, heading in itertools.product((1, 3, 8, 14, 40, 300), (0.0, 0.15, 0.5, 1.0), (0, 1)):
            assert html_text.kept(tree, (*before, words, links, *after, 2, 0, heading))
            if words >= 14 and links <= 0.5:                # on a page that marks no article
                assert html_text.kept(tree, (*before, words, links, *after, 1, 0, heading))
            assert not html_text.kept(tree, (*before, words, links, *after, 0, 0, heading))


@pytest.mark.parametrize("page, want", [
    ("<div><a href=x>Home page</a></div><article><h1>The title</h1><p>By A Writer</p></article>", "The title\nBy A Writer"),
    (f"<article><p>Start</p><p><a href=x>only a link</a></p><p>{LONG}</p></article><div>(c) us</div>", f"Start\nonly a link\n{LONG}"),
    (f"<article><p><a href=x>only a link</a></p><p>{LONG}</p></article>", f"only a link\n{LONG}"),
    (f"<p>{LONG}</p><p><a href=x>{'linked ' * 10}</a>{LONG[:209]}</p><p>{LONG}</p>", f"{LONG}\n{'linked ' * 10}{LONG[:209]}\n{LONG}"),
])
def test_neighbours_do_not_drop_main_text(page, want):
    assert text(page) == want


def test_neighbours_are_of_the_same_region():
    flat = html_text.blocks("<nav><a href=x>Home</a></nav><article><p>one two</p><aside>s</aside><p>three</p></article><footer>f</footer>")
    found = [f for f, b in zip(html_text.features(flat), flat) if not b.furniture]
    assert [f[:6] for f in found] == [(0, 0.0, 2, 0.0, 1, 0.0), (2, 0.0, 1, 0.0, 0, 0.0)]


@pytest.mark.parametrize("page, want", [
    ("<html><head><meta charset=utf-8><title>t</title><style>p{}</style><body><article><p>story</article>", "story"),
    ("<head><link rel=x><script>no</script><noscript><style>p{}</style></noscript><article><p>story</article>", "story"),
    ("<head><noscript><img src=x><body><article><p>story</article>", "story"), ("<head><title>t</title>plain story", "plain story"),
    ("<head><template><p>no</p></template><title>t</title></head><article>story</article>", "story"),
    ("<article><p class=ad>x<div>story</div></article>", "story"), ("<article><p class=ad>x<ul><li>story</ul><h2>more</h2></article>", "story\nmore"),
    ("<article><p class=ad>x <b>y<table><tr><td>story</table></article>", "story"), ("<article><p class=ad>x</p><div>story</div></p>more</article>", "story\nmore"),
    ("<article><ul><li class=ad>x<li>story</ul><dl><dt class=ad>x<dd>more</dl></article>", "story\nmore"),
    ("<article><ul><li class=ad>x<ul><li>y</ul><li>story</ul></article>", "story"),
    ("<article><table><caption class=ad>c<tr class=ad><td>x<tr><td class=ad>y<td>story<tbody><tr><td>more</table></article>", "story\nmore"),
    ("<div class=story>story<div>more</div><p class=ad>x<div>still</div></p>end</div>", "story\nmore\nstill\nend"),
])
def test_end_tags_left_out(page, want):
    assert text(page) == want


def test_deep_pages_take_linear_time():
    for page in ("<p>" * 100_000, "<div>" * 100_000, "<ul><li>" * 50_000, "<table><tr><td>" * 30_000, "<div><p>" * 50_000, "<object>" * 100_000):
        html_text.blocks(page)


WORDY = "this section of the article is about something that its name does not tell at all to anyone"


@pytest.mark.parametrize("page, want", [
    ("<article><h1>T</h1><h2 id=related-work>Related work</h2><p>a b</p><h2 id='search-results'>Search results</h2><p>c</p></article>",
     "T\nRelated work\na b\nSearch results\nc"),
    (f"<article><section id=discussion><h2>Discussion</h2><p>{WORDY}</p><p>short end</p></section></article>", f"Discussion\n{WORDY}\nshort end"),
    (f"<article><section id=cookie-recipes><h2>Cookie recipes</h2><p>{WORDY}</p></section></article>", f"Cookie recipes\n{WORDY}"),
    ("<div class='article-with-sidebar'><p>short</p><p>text</p></div><div>other</div>", "short\ntext"),
    (f"<article><div class='text-search-block'><p>{WORDY}</p></div></article>", WORDY),
    (f"<h1 class='page-header'>Title</h1><p>{WORDY}</p>", f"Title\n{WORDY}"),
    ("<article><div class='article-header'><h1>Title</h1></div><p>x</p></article>", "Title\nx"),
])
def test_a_furniture_word_alone_drops_no_text(page, want):
    assert text(page) == want


@pytest.mark.parametrize("part", [
    "<div class=ad>{}</div>", "<div class='ad-slot big'>{}</div>", "<div id=cookie-banner>{}</div>", "<section id=comments>{}</section>",
    "<section class='discussion'>{}</section>", "<div class='post-comments'>{}</div>", "<aside>{}</aside>", "<div id='siteFooter'>{}</div>",
    "<div class='related-posts'>{}</div>", "<div role=search>{}</div>", "<div id='newsletter-signup'>{}</div>",
])
def test_furniture_is_dropped_at_any_length(part):
    assert text(f"<article><p>story</p>{part.format(f'<p>{WORDY}</p>')}</article>") == "story"
    assert text(f"<p>{LONG}</p>{part.format(f'<p>{WORDY}</p>')}") == LONG


@pytest.mark.parametrize("part", [
    "<section id=related><h2>Related</h2><ul><li><a href=x>One story</a><li><a href=y>Another story</a></ul></section>",
    "<div class='my-share-box'><p>Share this</p></div>", "<section id=search><p>Search here</p></section>",
])
def test_short_and_linked_blocks_of_doubtful_parts_are_dropped(part):
    assert text(f"<article><p>story</p>{part}</article>") == "story"


def test_cards_marked_as_articles_do_not_hide_the_story():
    tree = html_text.train(html_text.LABELLED)
    story = " ".join(f"word{i}" for i in range(60))
    cards = "".join(f"<article><h3>Card {i}</h3><p>read this next</p></article>" for i in range(3))
    assert html_text.main_text(f"<main><h1>Title</h1><p>{story}</p><section>{cards}</section></main>", tree) == f"Title\n{story}"
    assert html_text.main_text(f"<div class='content'><p>{story}</p></div><article><p>a teaser of few words</p></article>", tree) == story
    # an article of its own size stays the story, whatever stands beside it
    assert html_text.main_text(f"<main><p>{story}</p><article><p>{story} end</p></article></main>", tree) == f"{story} end"
