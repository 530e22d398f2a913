"""Layer tables on Parquet with keyed writes (K1-K3, K6).

Every rewrite of a table goes to a new folder ``v=NNNNNN``; readers take the
newest one that Spark committed (``_SUCCESS``).  A killed write leaves the old
version readable and the next write takes the number after any folder that is
there.  A version that has been followed by two newer ones is removed.

Two layouts per table:

* **snapshot** (default, small tables): an upsert writes the whole new content.
  Insert-ignore only appends its new rows to the current version.
* **bucketed** (large tables): rows carry ``_bucket`` (a hash of the key) as a
  partition column.  A batch touches few buckets; only those are read
  (partition filter), merged and rewritten with dynamic partition overwrite
  inside the current version; the other buckets' files are left alone.
  Insert-ignore appends into the touched buckets.

A batch is computed once: it is staged in the table's own root, and the buckets
it touches and the merge are both taken from the staged rows.

The root should be on the shared file system (``spark.checkpoint.dir`` or a
lake path); nothing here uses a machine-local folder on a cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from ..schemas import TableSpec, empty
from . import keyed

BUCKET = "_bucket"
#: A digest of a row's non-key columns, written with the row (``strata.sinks.changes``).
DIGEST = "_digest"
#: Files a bucket is rewritten in, at most: one write task each.
FILES_PER_BUCKET = 4
#: A digest is hex text, which only a codec that codes letters brings back to its 8 bytes.
CODEC = "zstd"


def bucket_of(key: list[str], columns: list[str], buckets: int, null_keys: str = keyed.APPEND) -> Column:
    """The bucket of a row.  A key with a NULL part never clashes
    (``null_keys='append'``), so such rows are spread by all their columns
    instead of meeting in one bucket; they are never looked up."""
    b = F.xxhash64(*[F.col(k) for k in key])
    if null_keys == keyed.APPEND:
        null = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key])
        b = F.when(null, F.xxhash64(*[F.col(c) for c in columns])).otherwise(b)
    return F.pmod(b, F.lit(buckets)).cast("int")


# Keyed tables that take upserts: at scale they are bucketed so an upsert
# rewrites only the buckets its batch touches (insert-ignore tables only
# append, so the snapshot layout suits them at any size).
UPSERT_TARGETS = ("collect.tmx_authors", "collect.tmio_leaderboards", "conform.tmx_authors",
                  "conform.tmio_leaderboards", "consume.totd")


# Insert-ignore tables: bucketing them too lets a small batch anti-join only
# the buckets it touches instead of every stored key.
INSERT_TARGETS = ("collect.tmio", "collect.tmx", "conform.tmio", "conform.tmx",
                  "consume.totd_tags", "consume.totd_authors")


# Tables whose rows carry a digest: what later jobs read.
DIGESTED = ("collect.tmio", "collect.tmx", "collect.tmx_authors", "collect.tmio_leaderboards", "conform.tmio", "conform.tmx",
            "conform.tmx_authors", "conform.tmio_leaderboards", "ref.tmx_tags")


def digest_of(spec: TableSpec) -> Column:
    """64 bits of the non-key columns; a NULL column differs from an empty one.  Digests are only
    compared with one that the same key had before, so that as many bits as rows would ask for are not needed."""
    others = [c for c in spec.columns if c.name not in spec.key]
    # the hash passes over NULLs, so which columns are NULL is hashed too; nested ones are hashed by their text
    nulls = F.concat(F.lit(""), *[F.when(F.col(c.name).isNull(), "1").otherwise("0") for c in others])
    values = [F.to_json(F.struct(c.name), {"ignoreNullFields": "false"}) if "<" in c.dtype else F.col(c.name) for c in others]
    return F.hex(F.xxhash64(nulls, *values))


def upsert_buckets(n: int) -> dict[str, int]:
    return {name: n for name in UPSERT_TARGETS}


def keyed_buckets(n: int) -> dict[str, int]:
    """Every keyed layer table bucketed (the layout for large lakes)."""
    return {name: n for name in UPSERT_TARGETS + INSERT_TARGETS}


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: dict[str, int] | None = None,
                 files_per_bucket: int = FILES_PER_BUCKET, digested: tuple[str, ...] = DIGESTED):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = dict(buckets or {})
        self.files_per_bucket = files_per_bucket
        self.digested = digested

    # ---- file system helpers (Hadoop FS, so any shared store works) --------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _remove(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    # ---- layout ------------------------------------------------------------
    def table_dir(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def path(self, spec: TableSpec) -> str:
        """The folder of a table's versions.  A bucketed table lives in
        ``buckets=B``, so its bucket count is part of the layout."""
        b = self.bucket_count(spec)
        return f"{self.table_dir(spec)}/buckets={b}" if b else self.table_dir(spec)

    def bucket_count(self, spec: TableSpec) -> int:
        return self.buckets.get(spec.qualified, 0)

    def _check_layout(self, spec: TableSpec) -> None:
        """Refuse to mix layouts: reading a table with another bucket count
        (or as a snapshot table) would miss rows."""
        b = self.bucket_count(spec)
        for name in self._names(self.table_dir(spec)):
            if name.startswith(("buckets=", "v=")) and not (name == f"buckets={b}" if b else name.startswith("v=")):
                raise ValueError(f"{spec.qualified} is stored as {name!r}, not {f'buckets={b}' if b else 'v='!r}; "
                                 "move it over with copy_to")

    def _versions(self, spec: TableSpec, committed: bool = True) -> list[int]:
        base = self.path(spec)
        out = [int(name[2:]) for name in self._names(base) if name.startswith("v=")]
        return sorted(v for v in out if not committed or "_SUCCESS" in self._names(f"{base}/v={v:06d}"))

    def _current(self, spec: TableSpec) -> str | None:
        v = self._versions(spec)
        return f"{self.path(spec)}/v={v[-1]:06d}" if v else None

    def _next(self, spec: TableSpec) -> str:
        """The number after the highest folder in any state: a killed write's
        folder is never written into, and never read."""
        v = self._versions(spec, committed=False)
        return f"{self.path(spec)}/v={(v[-1] + 1 if v else 1):06d}"

    def _retire(self, spec: TableSpec) -> None:
        """Remove what is older than the version before the newest (a reader
        may still be on that one), uncommitted folders included."""
        done = self._versions(spec)
        if len(done) > 1:
            for v in self._versions(spec, committed=False):
                if v < done[-2]:
                    self._remove(f"{self.path(spec)}/v={v:06d}")

    def _read_raw(self, spec: TableSpec) -> DataFrame | None:
        self._check_layout(spec)
        current = self._current(spec)
        if current is None:
            return None
        schema = spec.struct
        if spec.qualified in self.digested:
            schema = schema.add(DIGEST, StringType())
        if self.bucket_count(spec):
            schema = schema.add(BUCKET, IntegerType())
        return self.spark.read.schema(schema).parquet(current)

    def _write(self, spec: TableSpec, df: DataFrame, path: str, mode: str, null_keys: str = keyed.APPEND, as_dealt: bool = False) -> None:
        """``as_dealt``: every task writes its own file of each bucket.  A table's first
        load is dealt by key already and fills every bucket, so its rows are not shuffled a second time."""
        b = self.bucket_count(spec)
        if b:
            df = df.withColumn(BUCKET, bucket_of(list(spec.key), spec.names, b, null_keys))
            if not as_dealt:
                # a bucket's rows meet in a few tasks, so it gets a few files and is still split
                part = F.pmod(F.hash(*[F.col(c) for c in spec.names if not spec.column(c).dtype.startswith("map")]), F.lit(self.files_per_bucket))
                df = df.repartition(F.col(BUCKET), part)
        if spec.qualified in self.digested:           # after the shuffle, which need not carry it
            df = df.withColumn(DIGEST, digest_of(spec))
        w = df.write.mode(mode).option("compression", CODEC)
        if b:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET)
        w.parquet(path)

    def stage_first(self, spec: TableSpec, df: DataFrame, path: str, null_keys: str = keyed.APPEND) -> DataFrame:
        """The first content of a table, of one row per key, written beside it in its layout."""
        self._write(spec, df.select(*spec.names), path, "errorifexists", null_keys, as_dealt=True)
        return self.spark.read.schema(spec.struct).parquet(path).select(*spec.names)

    def publish_first(self, spec: TableSpec, path: str) -> None:
        """The folder of ``stage_first`` becomes the table's next version by a rename."""
        self._check_layout(spec)
        to = self._next(spec)
        fs, p = self._fs(to)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._fs(path)[1], p):
            raise RuntimeError(f"{path} can't be renamed to {to}")

    def _first(self, spec: TableSpec, batch: DataFrame, keep: str, order_by: list[Column | str] | None, null_keys: str) -> None:
        """A table's first load.  The batch is written once, as its tasks come, and only its keys are
        shuffled to see that each stands on one row; then the folder becomes the first version.  Rows are ranked
        only where their key stands on several, and the content is then written anew."""
        key, path = list(spec.key), f"{self.root}/_staged/{spec.layer}_{spec.name}-{uuid.uuid4().hex[:12]}"
        try:
            rows = self.stage_first(spec, keyed.split_null_keys(batch.select(*spec.names), key, null_keys), path, null_keys)
            twice = keyed.keys_twice(rows, key, null_keys)
            if not twice.limit(1).count():
                self.publish_first(spec, path)
                return
            if keep == keyed.ERROR:
                raise ValueError("batch holds two rows for one key " + ",".join(key))
            same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(twice[f"_twice_{k}"]) for k in key])
            one = keyed.one_per_key(rows.join(twice, same, "left_semi"), key, keep, order_by, keyed.MATCH)
            self._write(spec, rows.join(twice, same, "left_anti").unionByName(one), self._next(spec), "errorifexists", null_keys, as_dealt=True)
        finally:
            self._remove(path)

    @contextmanager
    def _staged(self, spec: TableSpec, batch: DataFrame) -> Iterator[DataFrame]:
        """The batch, computed once and read back."""
        path = f"{self.root}/_staged/{spec.layer}_{spec.name}-{uuid.uuid4().hex[:12]}"
        batch.select(*spec.names).write.mode("errorifexists").option("compression", CODEC).parquet(path)
        try:
            yield self.spark.read.schema(spec.struct).parquet(path)
        finally:
            self._remove(path)

    def _touched(self, raw: DataFrame, spec: TableSpec, staged: DataFrame, null_keys: str) -> DataFrame:
        """The stored rows of the buckets that the staged batch touches.  At
        most B small ints reach the driver: the bucket ids, never rows."""
        b = bucket_of(list(spec.key), spec.names, self.bucket_count(spec), null_keys)
        ids = [r[0] for r in staged.select(b.alias(BUCKET)).distinct().collect()]
        return raw.filter(F.col(BUCKET).isin(ids)).select(*spec.names)

    # ---- reads and writes --------------------------------------------------
    def read(self, spec: TableSpec) -> DataFrame:
        df = self._read_raw(spec)
        return empty(self.spark, spec) if df is None else df.select(*spec.names)

    def exists(self, spec: TableSpec) -> bool:
        return self._current(spec) is not None

    def digests(self, spec: TableSpec) -> DataFrame:
        """The key and digest of every stored row, and no other column.  Rows written
        before digests were kept have a null one."""
        df = self._read_raw(spec)
        if df is None:
            df = empty(self.spark, spec).withColumn(DIGEST, F.lit(None).cast("string"))
        return df.select(*spec.key, DIGEST)

    def rows_of(self, spec: TableSpec, keys: DataFrame) -> DataFrame:
        """The stored rows whose key is in ``keys`` (NULL as a value)."""
        raw = self._read_raw(spec)
        if raw is None:
            return empty(self.spark, spec)
        nullable = [k for k in spec.key if k not in spec.not_null]
        if self.bucket_count(spec) and not any(keys.filter(F.col(k).isNull()).limit(1).count() for k in nullable):
            ids = [r[0] for r in keys.select(bucket_of(list(spec.key), list(spec.key), self.bucket_count(spec)).alias(BUCKET)).distinct().collect()]
            raw = raw.filter(F.col(BUCKET).isin(ids))
        raw, keys = raw.select(*spec.names), keys.select(*spec.key).distinct()
        if not nullable:            # dealt by the key itself, so that a join on it that follows needs no shuffle
            return raw.join(keys.hint("shuffle_hash"), list(spec.key), "left_semi").select(*spec.names)
        return raw.join(keys, reduce(lambda a, b: a & b, [raw[k].eqNullSafe(keys[k]) for k in spec.key]), "left_semi")

    def changes_only(self, spec: TableSpec, batch: DataFrame) -> DataFrame:
        """The batch without rows that are stored already, with the same key and content."""
        if spec.qualified not in self.digested or not self.exists(spec):
            return batch
        # joined on the key alone, so that a batch dealt by it is not shuffled again
        stored = self.digests(spec).withColumnRenamed(DIGEST, "_stored").hint("shuffle_hash")
        return (batch.withColumn(DIGEST, digest_of(spec)).join(stored, list(spec.key), "left")
                .filter(F.col("_stored").isNull() | (F.col("_stored") != F.col(DIGEST))).select(*batch.columns))

    def replace(self, spec: TableSpec, df: DataFrame) -> None:
        """New content as a new version; ``df`` may read the table itself."""
        self._check_layout(spec)
        self._write(spec, df.select(*spec.names), self._next(spec), "errorifexists")
        self._retire(spec)

    def append(self, spec: TableSpec, rows: DataFrame) -> None:
        """Rows added to a snapshot table by Spark's committer: all of them are
        seen, or none (an append that fails leaves no file that a reader lists)."""
        if self.bucket_count(spec):
            raise ValueError(f"{spec.qualified} is bucketed by its key; append is for tables without one")
        current = self._current(spec)
        self._write(spec, rows.select(*spec.names), current or self._next(spec), "append" if current else "errorifexists")

    def copy_to(self, spec: TableSpec, other: TableStore) -> None:
        """Rewrite a table into the layout of another store (another root or
        bucket count)."""
        other.replace(spec, self.read(spec))

    def insert_ignore(self, spec: TableSpec, batch: DataFrame,
                      order_by: list[Column | str] | None = None,
                      null_keys: str = keyed.APPEND) -> None:
        """K1: append batch rows whose key is not stored (first per key)."""
        key = list(spec.key)
        raw = self._read_raw(spec)
        current = self._current(spec)
        if raw is None:
            self._first(spec, batch, keyed.FIRST, order_by, null_keys)
        elif not self.bucket_count(spec):
            self._write(spec, keyed.new_rows(raw.select(*spec.names), batch, key, order_by, null_keys), current, "append")
        else:
            with self._staged(spec, batch) as staged:
                target = self._touched(raw, spec, staged, null_keys)
                self._write(spec, keyed.new_rows(target, staged, key, order_by, null_keys), current, "append", null_keys)

    def upsert(self, spec: TableSpec, batch: DataFrame, update_cols: list[str] | None = None,
               on_duplicate: str = keyed.ERROR, order_by: list[Column | str] | None = None,
               null_keys: str = keyed.APPEND) -> None:
        """K2/K3: rewrite only what the batch touches."""
        def merge(target: DataFrame, rows: DataFrame) -> DataFrame:
            return keyed.merge_upsert(target, rows, list(spec.key), update_cols, on_duplicate, order_by, null_keys)

        raw = self._read_raw(spec)
        if raw is None:
            self._first(spec, batch, on_duplicate, order_by, null_keys)
        elif not self.bucket_count(spec):
            self._write(spec, merge(raw.select(*spec.names), batch.select(*spec.names)), self._next(spec), "errorifexists", null_keys, as_dealt=True)
            self._retire(spec)
        else:
            with self._staged(spec, batch) as staged:
                if not staged.limit(1).count():
                    return                                # nothing to merge: no bucket is rewritten
                if not keyed.keys_twice(staged, list(spec.key), null_keys).limit(1).count():
                    on_duplicate = keyed.UNIQUE           # whole rows need not be ranked
                merged = merge(self._touched(raw, spec, staged, null_keys), staged)
                self._write(spec, merged, self._current(spec), "overwrite", null_keys)
