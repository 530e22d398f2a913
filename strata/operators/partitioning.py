"""Parallelism guard for CPU-heavy steps (JSON parsing and encoding)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import is_local_master

SETTING = "spark.strata.spreadTasks"


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Round-robin a freshly scanned frame over ``tasks`` tasks when the scan
    yields fewer partitions (a few small or unsplittable files ahead of per-row
    JSON work).

    Off unless asked for: ``tasks``, else the session's
    ``spark.strata.spreadTasks``, else 0 on a cluster and, on a local master,
    its cores.  Call it on scans only: it inspects the physical plan's partition
    count, which for a plan with shuffles would run them.
    """
    spark = df.sparkSession
    if tasks is None:
        usual = spark.sparkContext.defaultParallelism if is_local_master(spark.sparkContext.master) else 0
        tasks = int(spark.conf.get(SETTING, str(usual)))
    if not tasks or df.rdd.getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks)
