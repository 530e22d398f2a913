"""A1 / L3 as a walk that remembers how far it got: a streaming Python data source of pages.

Page 0 of the feed is the newest month, and every month moves all pages on by one.
So a page is known by its month (``year * 12 + month - 1``), and the offset of the
stream is the span of months reached, with a digest of the newest page:

* months between the ends of an earlier run are never asked for again;
* the newest month may still grow: when its page has changed, it is asked for again,
  with the months that came after it;
* a deeper walk asks only for the months below the lowest one reached.

One micro-batch is one round.  Its pages are input partitions, and each batch is landed
in a folder of its own, so a batch that is re-run after a failure replaces what it wrote.
"""

from __future__ import annotations

import hashlib
import json
import pickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions import documents as D
from ..operators.selection import newest
from .feeds import PAGE_SCHEMA, page_entries

FORMAT = "strata_walk"
LANDED = "month long, json_data string"


def month_of(page: str | None) -> int | None:
    """The month that a page document is of; ``None`` for an absent page."""
    if page is None:
        return None
    doc = json.loads(page)
    return int(doc["year"]) * 12 + int(doc["month"]) - 1


class Month(InputPartition):
    def __init__(self, month: int, newest: int):
        self.month, self.newest = month, newest


class WalkReader(DataSourceStreamReader):
    """Options: ``depth`` (months to reach back, the newest one included), ``lowest`` (the
    lowest month reached by earlier rounds, if any)."""

    def __init__(self, options, transport):
        self.depth = int(options["depth"])
        self.lowest = int(options["lowest"]) if "lowest" in options else None
        self.transport = transport

    def initialOffset(self) -> dict:
        return {"low": None, "high": None, "seen": None}

    def latestOffset(self) -> dict:
        page = self.transport.fetch([{"page_no": "0"}])[0]
        high = month_of(page)
        if high is None:
            return self.initialOffset()
        low = high - self.depth + 1
        return {"low": low if self.lowest is None else min(low, self.lowest), "high": high,
                "seen": hashlib.sha256(page.encode()).hexdigest()}

    def partitions(self, start: dict, end: dict) -> list[Month]:
        if end["high"] is None:
            return []
        if start["high"] is None:
            months = range(end["low"], end["high"] + 1)
        else:
            grown = start["seen"] != end["seen"] or start["high"] != end["high"]
            months = [*range(end["low"], start["low"]), *(range(start["high"], end["high"] + 1) if grown else ())]
        return [Month(m, end["high"]) for m in months]

    def read(self, partition: Month):
        page = self.transport.fetch([{"page_no": str(partition.newest - partition.month)}])[0]
        found = month_of(page)
        if found is not None and found != partition.month:
            # the feed has turned to a new month since the offset was taken: the next run sees it
            raise RuntimeError(f"page {partition.newest - partition.month} is of month {found}, not {partition.month}")
        yield (partition.month, page)


def walk_source(name: str, transport) -> type[DataSource]:
    class WalkSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return LANDED

        def streamReader(self, schema) -> DataSourceStreamReader:
            return WalkReader(self.options, transport)

    return WalkSource


def _landed(spark: SparkSession, home: str) -> DataFrame:
    """The landed page of each month: that of the latest batch.  An absent page is a null document."""
    pages = spark.read.schema(f"{LANDED}, batch long").parquet(f"{home}/pages")
    return pages.groupBy("month").agg(F.max_by("json_data", "batch").alias("json_data"))


def _round(spark: SparkSession, transport, home: str, depth: int, lowest: int | None) -> None:
    name = f"{FORMAT}-{hashlib.sha256(pickle.dumps(transport)).hexdigest()[:12]}"
    spark.dataSource.register(walk_source(name, transport))
    reader = spark.readStream.format(name).option("depth", depth)
    if lowest is not None:
        reader = reader.option("lowest", lowest)

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/pages/batch={number}")

    query = reader.load().writeStream.foreachBatch(land).option("checkpointLocation", f"{home}/offsets").trigger(availableNow=True).start()
    query.awaitTermination()


def resumed_feed(spark: SparkSession, transport, n: int | None, home: str, first_round: int = 4,
                 max_pages: int = 10_000, on_bad: str = D.FAIL) -> DataFrame:
    """The newest N day entries, as ``paged_feed`` gives them, of a feed of one page a month.

    ``home`` is a folder in shared storage that keeps the landed pages and the stream's
    offsets.  A later call with the same ``home`` asks for page 0, for the months
    since, and for deeper ones only when ``n`` needs them.  The feed ends at the newest absent
    month; a walk of ``max_pages`` months that holds neither ``n`` entries nor that end fails.
    Only the numbers of a round (entries held, lowest month, end) reach the driver.
    """
    entries = F.size(F.filter(D.parse("json_data", PAGE_SCHEMA, on_bad).getField("days"), lambda d: d.isNotNull()))
    held_of = F.when(F.col("json_data").isNotNull(), F.when(entries >= 0, entries).otherwise(
        F.raise_error(F.concat(F.lit("a page without a list of days, of month "), F.col("month")))))
    _ensure(spark, home)
    depth, lowest = min(first_round, max_pages), _lowest(spark, home)
    while True:
        _round(spark, transport, home, depth, lowest)
        pages = _landed(spark, home)
        end = pages.filter("json_data IS NULL").agg(F.max("month")).first()[0]
        if end is not None:
            pages = pages.filter(F.col("month") > end)
        got = pages.agg(F.sum(held_of).alias("held"), F.max("month").alias("high"), F.min("month").alias("low")).first()
        if end is not None or got.high is None or (n is not None and got.held >= n):
            break
        reached = got.high - got.low + 1
        if reached >= max_pages:
            raise RuntimeError(f"the feed goes on after {reached} pages, with {got.held} entries held")
        lowest, depth = got.low, min(max_pages, reached + max(first_round, reached))
    days = page_entries(pages, on_bad=on_bad)
    return newest(days, n, [F.col("month").desc(), F.col("data_day").desc(), F.col("data_slot").asc()]).drop("month")


def _ensure(spark: SparkSession, home: str) -> None:
    """An empty landing folder, so that the first round has something to read beside it."""
    spark.createDataFrame([], LANDED).write.mode("ignore").parquet(f"{home}/pages/batch=-1")


def _lowest(spark: SparkSession, home: str) -> int | None:
    return spark.read.schema(f"{LANDED}, batch long").parquet(f"{home}/pages").agg(F.min("month")).first()[0]
