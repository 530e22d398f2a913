"""Operator 6: token counts by heap-and-linked-list byte-pair merging.

The text is split into pre-tokens by the vocabulary's own pattern.  Each
pre-token is a linked list of byte symbols; a heap gives the lowest-rank
adjacent pair, which is merged, and the pairs it makes with its neighbours are
pushed.  The count is the number of bytes less the number of merges, so no
identifiers are made.  O(n log n) for a pre-token of n bytes, whatever its
length.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

# The split pattern of byte-level vocabularies.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \u0085 "
#: The same split for texts below U+0250, where the classes can be spelt out; about 1.5 times as fast.
_NEAR = re.compile(
    rf" ?[{_LETTER}]++|'(?:[stmd]|re|ve|ll)| ?[{_NUMBER}]++| ?[^{_SPACE}{_LETTER}{_NUMBER}]++"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_IS_NEAR = re.compile("[\u0000-ɏ]*+")
# \s of the vocabularies' pattern is Unicode white space, without U+001C-U+001F.
_FAR = regex.compile(SPLIT_PATTERN.replace(r"\s\p", r"\p{White_Space}\p").replace(r"\s", r"\p{White_Space}")
                     .replace(r"\S", r"\P{White_Space}"))


def pre_tokens(text: str) -> list[str]:
    return (_NEAR if _IS_NEAR.fullmatch(text) else _FAR).findall(text)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for U+0100 onwards in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


#: Pre-tokens that a worker remembers, about 100 MB of them.
CACHE = 500_000


class Remembered(dict):
    """Pre-token -> what ``make`` gives for it, made when first asked for.

    Bounded: when full it forgets everything and starts anew.  No result
    depends on what is remembered.
    """

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, word: str):
        if len(self) >= self.size:
            self.clear()
        made = self[word] = self.make(word)
        return made


class MergeCounter:
    """Counts the tokens of whole texts.  ``spec`` is the vocabulary file's JSON."""

    def __init__(self, spec: bytes, cache_size: int = CACHE):
        d = json.loads(spec)
        vocab = d["model"]["vocab"]
        self.start = [vocab[c] for c in byte_symbols()]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(d["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a] << 32 | vocab[b]] = r
            self.made.append(vocab[a + b])
        special = [t["content"] for t in d.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.counts = Remembered(lambda word: self.merged(word.encode()), cache_size)

    def merged(self, word: bytes) -> int:
        """Tokens of one pre-token: its bytes less the merges made."""
        rank, made = self.rank, self.made
        sym = [self.start[b] for b in word]
        n = left = len(sym)
        heap = []
        for i in range(n - 1):
            r = rank.get(sym[i] << 32 | sym[i + 1])
            if r is not None:
                heap.append(r << 32 | i)
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            # an entry is stale when a neighbour has merged since it was pushed
            if j >= n or sym[i] < 0 or rank.get(sym[i] << 32 | sym[j]) != r:
                continue
            sym[i], sym[j] = made[r], -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                q = rank.get(sym[i] << 32 | sym[k])
                if q is not None:
                    heappush(heap, q << 32 | i)
            h = before[i]
            if h >= 0:
                q = rank.get(sym[h] << 32 | sym[i])
                if q is not None:
                    heappush(heap, q << 32 | h)
        return left

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special string inside it is one token."""
        if self.special is None:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, pre_tokens(text)))


_COUNTERS: dict[int, MergeCounter] = {}


def counter_of(spec: bytes) -> MergeCounter:
    """One counter per vocabulary and worker process; its cache outlives a task."""
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = MergeCounter(spec)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file (``tokenizers`` JSON);
    the driver reads it and broadcasts its bytes (a few MB, fixed by the file).
    No begin, end or added special tokens; special strings inside a text count
    as one token, as the library takes them by default.  Null and empty texts
    count 0 bytes and 0 tokens.  One row out per row in, repeated rows and null
    ids included; an empty table gives an empty result; extra columns are not
    read.  No shuffle: a narrow map over the scan.
    """
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: dict) -> dict:
        counter = counter_of(spec.value)
        n_tokens = [counter.count(t) for t in batch["text"]]
        return {"id": batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": n_tokens,
                "over_limit": [n > limit for n in n_tokens]}

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return (map_rows(src, run, "id long, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_col))
