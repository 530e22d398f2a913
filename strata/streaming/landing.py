"""ST1: incremental landing.

Each scheduled run picks up only the response files that arrived since the
last run (the file source's checkpoint remembers what was read) and hands
them, one micro-batch at a time, to the same keyed sink the batch jobs use.
``trigger(availableNow=True)`` makes a run process what is there and stop,
which is what a daily re-run needs.

A batch that is re-run after a failure is handed to the sink again.  Insert-ignore
and upsert merge it again, but rows with a NULL key match nothing and would be
appended a second time.  ``EpochSink`` keeps a mark per micro-batch beside the
rows: the rows a batch appends carry the batch's name, and a batch that finds
its name among the stored rows has its NULL-key rows left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import Col, TableSpec
from ..sinks.store import TableStore

EPOCH = "_epoch"


class EpochSink:
    """A ``foreachBatch`` sink into one keyed table whose NULL-key rows are
    appended once, however often a batch is re-run.

    ``write(store, spec, batch)`` is the keyed write (``insert_ignore``, ``upsert``) of
    the rows with a whole key.  Rows with a NULL in the key go to a table
    ``<name>_unkeyed`` of the same columns and the mark ``_epoch``: the stream's name and the
    batch's number.  A version of that table is committed whole or not at all, so the
    mark is there exactly when its rows are.  ``read`` gives both parts as one table."""

    def __init__(self, store: TableStore, spec: TableSpec, stream: str, write: Callable[[TableStore, TableSpec, DataFrame], None]):
        self.store, self.spec, self.stream, self.write = store, spec, stream, write
        self.unkeyed = TableSpec(spec.layer, f"{spec.name}_unkeyed", spec.columns + (Col(EPOCH, "string"),))

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.spec.key])
        batch = batch.select(*self.spec.names).persist()
        try:
            mark = f"{self.stream}:{epoch}"
            done = self.store.read(self.unkeyed).filter(F.col(EPOCH) == mark).limit(1).count()
            if not done:
                self.store.append(self.unkeyed, batch.filter(no_key).withColumn(EPOCH, F.lit(mark)))
            self.write(self.store, self.spec, batch.filter(~no_key))
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        return self.store.read(self.spec).unionByName(self.store.read(self.unkeyed).drop(EPOCH))


def land_increments(spark: SparkSession, source_dir: str, schema: StructType | str,
                    sink: Callable[[DataFrame, int], None], checkpoint: str,
                    fmt: str = "json", max_files_per_trigger: int | None = None) -> None:
    """Run once over the files not seen yet, then stop."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(source_dir).writeStream
         .foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
