"""Operator 3: benchmark decontamination by Wu-Manber multi-pattern search.

Texts and patterns are sequences of words.  Patterns are the benchmark's
windows of ten consecutive words, and whole items that are shorter; those of
one length are searched together.  A table over blocks of two words says how
far the search may skip from a place where that block ends; where it may not
skip, the block's bucket lists the patterns that end in it, and those are
compared word by word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8, written

WINDOW = 10
#: Patterns in one search; more are searched in turn, each from a broadcast of this size at most.
SEARCH_PATTERNS = 50_000

#: Words of lower-cased UTF-8: every byte beyond ASCII belongs to a word.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Search:
    """Wu-Manber over words, for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1              # the skip where a block stands in no pattern
        self.shift: dict = {}
        self.bucket: dict = {}                          # last block -> first word -> patterns to compare
        for p, items in patterns.items():
            for end in range(self.block, length + 1):
                b = p[end - 2:end] if self.block == 2 else p[0]
                self.shift[b] = min(self.shift.get(b, self.far), length - end)
            self.bucket.setdefault(b, {}).setdefault(p[0], []).append((p, items))

    def __call__(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(start, items) of every occurrence."""
        length, far, skip = self.length, self.far, self.shift.get
        n, end = len(words), length
        if self.block == 1:
            for i, w in enumerate(words):
                for _, items in self.bucket.get(w, {}).get(w, ()):
                    yield i, items
            return
        while end <= n:
            b = (words[end - 2], words[end - 1])
            d = skip(b, far)
            if d:
                end += d
                continue
            start = end - length
            for p, items in self.bucket[b].get(words[start], ()):
                if p == tuple(words[start:end]):
                    yield start, items
            end += 1


def compile_search(patterns: list[tuple[list[bytes], list[str]]]) -> list[Search]:
    by_length: dict[int, dict] = {}
    for words, items in patterns:
        by_length.setdefault(len(words), {})[tuple(words)] = items
    return [Search(n, by_length[n]) for n in sorted(by_length)]


def patterns_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct patterns and the names of their items: (words array<binary>,
    items array<string>).  An item with a null id has the empty name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            name, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(t)
                for at in range(max(1, len(w) - window + 1) if w else 0):
                    name.append(i)
                    out.append(w[at:at + window])
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(out, pa.list_(pa.binary()))],
                                             names=["item", "words"])

    src = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), utf8(text_col))
    return (src.mapInArrow(run, "item string, words array<binary>")
            .groupBy("words").agg(F.collect_set("item").alias("items")))


def find(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, search_patterns: int = SEARCH_PATTERNS,
         out_col: str = "found") -> DataFrame:
    """``docs`` with a column ``found``: struct(n_words long, hits array<struct<start, end>>,
    items array<string>) - the words of the whole text, the maximal runs of words
    inside any occurrence of a pattern, and the items that occur, sorted as strings.

    All columns of ``docs`` are kept as they are; ``out_col`` must not be among
    them.  Null and empty texts have no words; items without words have no
    patterns.  The benchmark may be of any size: patterns are dealt into
    searches of at most ``search_patterns`` on average, each broadcast and run
    in turn over the rows, which carry their hits along; between two searches
    the rows are written to the shared folder.
    """
    if out_col in docs.columns:
        raise ValueError(f"documents already have a column {out_col}")
    spark = docs.sparkSession
    patterns = written(patterns_of(items, item_id_col, item_text_col, window), "patterns")
    parts = max(1, -(-patterns.count() // search_patterns))
    out = T._parse_datatype_string("n_words long, hits array<struct<start:int,end:int>>, items array<string>")
    rows = docs.withColumn(out_col, F.lit(None).cast(out))
    for k in range(parts):
        own = patterns.filter(F.pmod(F.xxhash64(F.col("words").cast("array<string>")), F.lit(parts)) == k).collect()
        shared = spark.sparkContext.broadcast([([bytes(w) for w in r["words"]], r["items"]) for r in own])
        rows = rows.withColumn(out_col, _searcher(shared, out)(utf8(text_col), F.col(out_col)))
        if k + 1 < parts:
            rows = written(rows, "searched")
    return rows


_COMPILED: dict = {}


def _searcher(shared, out: T.StructType):
    """The column function of one search: (text, what earlier searches found) -> found."""
    def look(texts: pa.Array, before: pa.Array) -> pa.Array:
        key = id(shared)
        if key not in _COMPILED:
            _COMPILED.clear()
            _COMPILED[key] = shared, compile_search(shared.value)
        searches = _COMPILED[key][1]
        made = []
        for t, old in zip(texts, before):
            words = words_of(t.as_py())
            spans, names = [], set()
            if old.is_valid:
                old = old.as_py()
                names.update(old["items"])
                spans = [(h["start"], h["end"]) for h in old["hits"]]
            for s in searches:
                for start, items in s(words):
                    spans.append((start, start + s.length))
                    names.update(items)
            made.append({"n_words": len(words), "hits": [{"start": a, "end": b} for a, b in merged(spans)],
                         "items": sorted(names)})
        return pa.array(made, type=kind)

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(out)
    look.__annotations__ = {"texts": pa.Array, "before": pa.Array, "return": pa.Array}
    return F.arrow_udf(look, out).asNondeterministic()      # run once, though several columns come from it


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that touch or overlap, joined; sorted by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def n_hit(found: str = "found"):
    """Words inside any occurrence."""
    return F.aggregate(F.col(f"{found}.hits"), F.lit(0).cast("long"), lambda s, h: s + (h["end"] - h["start"]))
