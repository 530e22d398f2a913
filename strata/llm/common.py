"""Shared pieces of the training-data operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import apply_conf, scratch_path

#: Rows per Arrow batch.  Texts are long and whole, so batches hold few of them.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on: the library's own, and short Arrow batches."""
    apply_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """A text column as its UTF-8 bytes; null counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("binary"), F.lit(b""))


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over column dicts: ``fn`` turns one batch (column name ->
    list) into one batch of output columns."""
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """Cut lineage: write to the cluster's shared folder and read back, so a
    lost executor re-reads files and no task is computed a second time.  With
    ``free`` the shuffle files of finished steps go at once, worth its time after large steps."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if free:
        release(spark)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps now: it
    acts on what the driver's JVM has collected as garbage.  The last step's own
    bookkeeping still holds its files for a moment, hence the second round."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.3)
    spark.sparkContext._jvm.System.gc()


def learning_rows(doc_id: str | Column) -> Column:
    """Rows that may be learnt from: crc32(doc_id as text) mod 3 is not 1."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 3 != 1


def held_out(doc_id: str) -> Column:
    """True where the row is kept out of learning; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
