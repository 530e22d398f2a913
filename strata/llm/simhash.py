"""Operator 7: SimHash near-duplicates by multi-index hashing.

Every document gets a 64-bit fingerprint.  Equal fingerprints are one class.
Each class's fingerprint is cut into two 32-bit segments.  Three differing bits
or fewer leave one segment with at most one, so a ball of radius 1 around each
segment finds every link: a class is listed in the table under its two
segments, and looks itself up under each segment with one zero bit set (when
two segments differ in one bit, one of them has a zero there).  Classes that
meet under a key are compared over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, map_rows, utf8, written
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Rows under one key that one task compares; longer keys are dealt out in blocks.
KEY_ROWS = 50_000

_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of ``hashes`` (uint64)."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)]
        part = np.concatenate((part, np.zeros(-len(part) % 128, np.uint64)))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.reshape(-1, 128, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """SimHash of a whole text (UTF-8): A-Z lower-cased, words between ASCII
    white space, k-word shingles with their repeats.  A text of fewer words is
    one shingle, a text without words has fingerprint zero."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < k:
        return _HASH(b" ".join(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
    return majority(np.fromiter(map(_HASH, shingles), np.uint64, len(words) - k + 1))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """(doc_id long, text_hash long, fp long) for every row; ``fp`` holds the 64
    bits as a signed long, ``text_hash`` is the xxhash64 of the whole text."""
    def run(batch: dict) -> dict:
        made = np.array([fingerprint(t, k) for t in batch["text"]], np.uint64)
        return {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": made.view(np.int64)}

    text = utf8(text_col)
    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")),
                    run, "doc_id long, text_hash long, fp long")


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest (pairs of places) of the links among ``fps``: each
    place is taken once and compared with those not yet reached."""
    links, left = [], np.arange(len(fps))
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            i = reached.pop()
            near = np.bitwise_count(fps[left] ^ fps[i]) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                links += [(i, j) for j in found]
                reached += found.tolist()
    return links


def _compare(max_bits: int, key_rows: int | None):
    """Links within each run of equal keys, in rows sorted by key (table rows
    first).  A run of more than ``key_rows`` rows is passed on as it is instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("own", pa.bool_())])
        held = [np.empty(0, t) for t in (np.int64, bool, np.int64)]
        passing = None                                   # a key whose rows are passed on

        def on(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, own, fp = rows
            return pa.RecordBatch.from_arrays([pa.array(fp), pa.array(fp), pa.array(key), pa.array(own)], schema=schema)

        def links(rows: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            key, own, fp = rows
            out: list[tuple[int, int]] = []
            for s, e in zip(starts, ends):
                if e - s > 1 and own[s]:                 # something is listed under the key
                    out += [(fp[s + i], fp[s + j]) for i, j in forest(fp[s:e].view(np.uint64), max_bits)]
            if out:
                a, b = np.array(out, np.int64).T
                n = len(a)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())],
                                                 schema=schema)

        for b in batches:
            rows = [np.concatenate((h, b.column(c).to_numpy(zero_copy_only=False))) for h, c in zip(held, ("key", "own", "fp"))]
            if passing is not None:
                n = int(np.searchsorted(rows[0], passing, side="right"))
                if n:
                    yield on([r[:n] for r in rows])
                    rows = [r[n:] for r in rows]
            key = rows[0]
            if not len(key):
                held = rows
                continue
            passing = None if not len(key) else passing if passing == key[-1] else None
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            yield from links(rows, starts[:-1], starts[1:])
            held = [r[starts[-1]:] for r in rows]        # the last run may go on in the next batch
            if key_rows is not None and len(held[0]) > key_rows:
                passing = int(held[0][0])
                yield on(held)
                held = [r[:0] for r in held]
        if len(held[0]):
            yield from links(held, np.array([0]), np.array([len(held[0])]))

    return run


_LINKS = "a long, b long, key long, own boolean"


def links(classes: DataFrame, max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Links (a, b) between fingerprints that connect those of ``classes`` (fp
    long, each once) as all pairs of ``max_bits`` (at most 3) differing bits or
    fewer would.  Under each key a spanning forest is enough, so a key of n classes
    gives n - 1 links and not its pairs."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments and balls of radius 1 find links of at most 3 bits")
    places = F.expr("filter(sequence(-2, 63), b -> b < 0 OR (shiftright(fp, b) & 1L) = 0L)")
    listed = (classes.select("fp", F.explode(places).alias("bit"))
              .withColumn("own", F.col("bit") < 0)
              .withColumn("seg", F.expr("CASE WHEN bit < 0 THEN bit + 2 ELSE bit DIV 32 END").cast("int"))
              .withColumn("part", F.expr("shiftrightunsigned(fp, seg * 32) & 4294967295L"))
              .select(F.expr("(shiftleft(CAST(seg AS LONG), 32) | part) | "
                             "CASE WHEN own THEN 0L ELSE shiftleft(1L, CAST(bit % 32 AS INT)) END").alias("key"),
                      "own", "fp"))

    def compared(rows: DataFrame, limit: int | None) -> DataFrame:
        return (rows.repartition("key").sortWithinPartitions("key", F.col("own").desc(), "fp")
                .select("key", "own", "fp").mapInArrow(_compare(max_bits, limit), _LINKS))

    first = written(compared(listed, key_rows), "simhash-links")
    found = first.filter("key IS NULL").select("a", "b")
    long_keys = first.filter("key IS NOT NULL").select("key", "own", F.col("a").alias("fp"))
    if long_keys.limit(1).count():
        # deal each long key into blocks, and compare every two blocks in a task of their own
        blocks = long_keys.groupBy("key").agg(F.ceil(F.count("*") * 2 / key_rows).cast("int").alias("n"))
        dealt = (long_keys.join(blocks, "key").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
                 .withColumn("j", F.explode(F.expr("sequence(0, n - 1)")))
                 .withColumn("key", F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")))
                 .withColumn("own", F.lit(True)))
        found = found.union(compared(dealt, None).select("a", "b"))
    return found


def _grouped(docs: DataFrame, id_col: str, text_col: str, k: int, max_bits: int, key_rows: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row: ``root`` is the
    smallest fingerprint of the row's group, ``component_id`` its smallest id."""
    fps = written(fingerprints(docs, id_col, text_col, k), "fingerprints")
    classes = fps.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes, max_bits, key_rows)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    member = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_hash) for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest
    doc_id that can be reached over links of ``max_bits`` differing bits or
    fewer, the row's own included.  Null, empty and blank texts have fingerprint
    zero and are linked like any other.  Repeated rows give a row each; rows of
    one id with different texts are told apart by their fingerprints.  A row with a null id has a fingerprint, takes no part
    in links, and has a null component.  An empty table gives an empty result;
    extra columns are not read.  ``text_hash`` is the xxhash64 of the whole text,
    which tells rows of one id apart.

    Fingerprints are written once (16 bytes a document).  Copies collapse in a
    partial minimum before anything else is shuffled, so a hot text costs one
    class.  The classes of a hot key are compared in blocks.
    """
    return (_grouped(docs, id_col, text_col, k, max_bits, key_rows)
            .select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
                    "text_hash"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, of which one document of
    each group of near-duplicates stays: the one with the smallest id, once.  If
    that id is repeated in the group, the row of smallest text hash stays, then of
    smallest other columns.  An id that is the smallest of several groups (on
    unrelated texts) stays once in each.  Rows with a null id are in no group and stay."""
    hashed, place = fresh(docs, "text_hash"), fresh(docs, "place")
    stay = written(_grouped(docs, id_col, text_col, k, max_bits, KEY_ROWS).filter("doc_id = component_id")
                   .groupBy("root", F.col("doc_id").alias(id_col)).agg(F.min("text_hash").alias(hashed))
                   .select(id_col, hashed), "near-duplicates")
    same = Window.partitionBy(id_col, hashed).orderBy(*[F.col(f"`{c}`") for c, t in docs.dtypes
                                                        if c not in (id_col, text_col) and not t.startswith(("map", "variant"))] or [F.lit(0)])
    named = (docs.filter(F.col(id_col).isNotNull()).withColumn(hashed, F.xxhash64(utf8(text_col)))
             .join(stay, [id_col, hashed], "left_semi")
             .withColumn(place, F.row_number().over(same)).filter(F.col(place) == 1))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return named.select(*columns).union(docs.filter(F.col(id_col).isNull()).select(*columns))
