"""Change propagation between stored layers.

A ``TableStore`` keeps a digest of the non-key columns beside every row of its
layer tables (``store.DIGESTED``), written with the row.  A *consumer* (one job)
keeps a small table of the keys and digests it has taken in.  The rows that
changed since are an anti join of two narrow scans, keys and digests only; a
job parses and merges those rows and then marks them as taken in.

The mark follows the job's own write.  A job that fails in between finds the same
rows changed when it is run again, and its keyed sink takes them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Col, TableSpec
from . import keyed
from .store import CODEC, DIGEST, TableStore

LAYER = "progress"


class Changes:
    """The rows of ``source`` that a consumer has not taken in as they are now.

    ``keys`` holds their keys and digests, written once, so what is
    marked in the end is what was looked at in the beginning.  ``whole``: every row is one of them."""

    def __init__(self, store: TableStore, source: TableSpec, keys: DataFrame, any_keys: bool, whole: bool = False):
        self.store, self.source, self.keys, self.any, self.whole = store, source, keys, any_keys, whole

    def rows(self) -> DataFrame:
        """The changed rows themselves.  A bucketed source is read only in the buckets they
        lie in, and no key is looked up when all rows have changed."""
        return self.store.read(self.source) if self.whole else self.store.rows_of(self.source, self.keys)


def _progress(store: TableStore, consumer: str, source: TableSpec) -> TableSpec:
    spec = TableSpec(LAYER, consumer, tuple(Col(k, source.column(k).dtype) for k in source.key) + (Col(DIGEST, "string"),), key=source.key)
    if store.bucket_count(source):          # as many buckets as the source, so that a small change rewrites few
        store.buckets.setdefault(spec.qualified, store.bucket_count(source))
    return spec


def pending(store: TableStore, consumer: str, source: TableSpec, target: TableSpec, current: DataFrame | None = None) -> DataFrame:
    """Key and digest of the rows of ``source`` that ``consumer`` has not taken in as they are."""
    spec = _progress(store, consumer, source)
    now = store.digests(source) if current is None else current
    if store.exists(spec) and store.exists(target):
        seen = store.read(spec)
        same = reduce(lambda a, b: a & b, [now[c].eqNullSafe(seen[c]) for c in [*source.key, DIGEST]])
        now = now.join(seen.hint("shuffle_hash"), same, "left_anti")        # what was taken in is held, not sorted
    return now.select(*source.key, DIGEST)


def _one_per_key(now: DataFrame, source: TableSpec, stored: bool) -> DataFrame:
    """One row per key.  The rows that a keyed sink ``stored`` can only share a key with a NULL part."""
    key = list(source.key)
    if not stored:
        return keyed.one_per_key(now, key, keyed.FIRST, [DIGEST])
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return now.filter(~null).unionByName(keyed.one_per_key(now.filter(null), key, keyed.FIRST, [DIGEST]))


@contextmanager
def changed(store: TableStore, consumer: str, source: TableSpec, target: TableSpec, current: DataFrame | None = None) -> Iterator[Changes]:
    """What of ``source`` has changed since ``consumer`` last finished; marked as
    taken in when the block ends without an error.

    ``current`` (the source's key and ``_digest``) replaces the stored digests where
    a row's meaning depends on other tables too.  All rows count as changed when the target
    has never been written.  A NULL in a key is compared as a value; of several rows
    on such a key one is remembered, the others are taken in by every run.

    The keys of a consumer's first run are written as its progress table and only renamed in the end."""
    spec = _progress(store, consumer, source)
    path = f"{store.root}/_changed/{consumer}-{uuid.uuid4().hex[:12]}"
    now, first = pending(store, consumer, source, target, current), not store.exists(spec)
    try:
        if first:
            keys = store.stage_first(spec, _one_per_key(now, source, current is None), path, keyed.MATCH)
        else:
            now.write.mode("errorifexists").option("compression", CODEC).parquet(path)
            keys = store.spark.read.schema(spec.struct).parquet(path)
        found = Changes(store, source, keys, keys.limit(1).count() > 0, first and current is None)
        yield found
        if found.any and first:
            store.publish_first(spec, path)
        elif found.any:
            store.upsert(spec, keys, on_duplicate=keyed.FIRST, order_by=[DIGEST], null_keys=keyed.MATCH)
    finally:
        store._remove(path)
