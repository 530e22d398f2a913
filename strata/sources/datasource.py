"""A1 as a Python Data Source: ``spark.read.format("strata_pages-...")``.

One ``InputPartition`` per page number, so the pages of a round are fetched
in parallel, each by one task, through the pluggable transport.  The transport
is bound to the registered source class, which Spark sends to the tasks; it is
no option, so its headers never show in a plan or a log.
"""

from __future__ import annotations

import hashlib
import pickle

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "strata_pages"


class PagesReader(DataSourceReader):
    def __init__(self, options, transport):
        self.first = int(options.get("first", 0))
        self.count = int(options["count"])
        self.transport = transport

    def partitions(self):
        return [InputPartition(p) for p in range(self.first, self.first + self.count)]

    def read(self, partition):
        page = partition.value
        yield (page, self.transport.fetch([{"page_no": str(page)}])[0])


def pages_source(name: str, transport) -> type[DataSource]:
    """A source of one transport's pages; options ``first`` (first page number,
    default 0) and ``count`` (pages to read)."""

    class PagesSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page_no bigint, json_data string"

        def reader(self, schema) -> DataSourceReader:
            return PagesReader(self.options, transport)

    return PagesSource


_REGISTERED: set[tuple[str, str]] = set()


def read_pages(spark: SparkSession, transport, first: int, count: int) -> DataFrame:
    name = f"{FORMAT}-{hashlib.sha256(pickle.dumps(transport)).hexdigest()[:12]}"
    key = spark.sparkContext.applicationId, name
    if key not in _REGISTERED:
        spark.dataSource.register(pages_source(name, transport))
        _REGISTERED.add(key)
    return spark.read.format(name).option("first", first).option("count", count).load()
