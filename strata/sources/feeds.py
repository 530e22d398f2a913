"""Feed sources: keyed fetch (A2-A4) and the paged walk (A1).

The fetch runs on executors or, for a ``TableTransport``, as a join; documents
never pass through the driver.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import documents as D
from ..operators.selection import newest
from .asking import Answer
from .datasource import read_pages
from .transports import TableTransport


def keyed_fetch(keys: DataFrame, transport, key_cols: list[str], doc_col: str = "json_data",
                partitions: int | None = None, error_col: str | None = None, deal_by: str | None = None) -> DataFrame:
    """A2/A3/A4: one response per key -> rows(key..., doc_col).

    Repeated keys are asked once; a key with a NULL part can't be asked for and
    is left out.  The transport gets every part as text, whatever its type.
    Keys are spread over ``partitions`` tasks, so fetches run in parallel (the
    session's ``spark.strata.fetchTasks``, else its default parallelism).  A key
    without a response has a NULL document; ``responses`` settles what is stored.

    A key whose request failed for good fails the job, unless ``error_col`` names a
    column for the reason: then every key has its row, and only those that failed
    have a reason.

    ``deal_by``: the key column that the stored rows will be dealt by.  Responses of a table are then
    dealt by it alone, so that the sink need not shuffle the documents again.
    """
    keys = keys.select(*key_cols).dropna()
    if deal_by is None or not isinstance(transport, TableTransport):
        keys = keys.dropDuplicates(key_cols)
    if isinstance(transport, TableTransport):
        resp = transport.responses.select(
            *[F.col(a).alias(b) for a, b in zip(transport.key_cols, key_cols)],
            F.col(transport.doc_col).alias(doc_col))
        if deal_by is not None:
            keys, resp = keys.repartition(deal_by).dropDuplicates(key_cols), resp.repartition(deal_by)
        got = keys.hint("shuffle_hash").join(resp, key_cols, "left")       # the keys are held, the documents stream past them
        return got if error_col is None else got.withColumn(error_col, F.lit(None).cast("string"))
    spark = keys.sparkSession
    n = partitions or int(spark.conf.get("spark.strata.fetchTasks", str(spark.sparkContext.defaultParallelism)))
    keys = keys.repartition(n, *key_cols)
    asked = keys.select(*key_cols, *[F.col(c).cast("string").alias(f"_asked_{c}") for c in key_cols])
    extra = [doc_col] if error_col is None else [doc_col, error_col]
    schema = StructType(list(keys.schema.fields) + [StructField(c, StringType()) for c in extra])

    def fetch(batches):
        asker = transport.asker(n) if hasattr(transport, "asker") else None
        for pdf in batches:
            requests = [dict(zip(key_cols, r)) for r in zip(*(pdf[f"_asked_{c}"] for c in key_cols))]
            if asker is None:
                answers = [Answer(text) for text in (transport.fetch(requests) if requests else [])]
            else:
                answers = asker.ask(requests)
            failed = next((f"no answer for {k}: {a.error}" for k, a in zip(requests, answers) if a.error is not None), None)
            if failed is not None and error_col is None:
                raise RuntimeError(failed)
            found = dict(zip((doc_col, error_col), zip(*answers))) if answers else {doc_col: [], error_col: []}
            yield pdf[key_cols].assign(**{c: pd.Series(found[c], index=pdf.index, dtype=object) for c in extra})

    return asked.mapInPandas(fetch, schema)


def responses(fetched: DataFrame, doc_col: str = "json_data") -> DataFrame:
    """What of a fetch may be stored: a key without a response is left out (it is
    asked again by the next run), and a body that is not JSON fails the job, so
    that an error page never reaches a collect table."""
    body = F.col(doc_col)
    parsed = F.when(D.is_bad_json(body), F.raise_error(F.concat(F.lit("the response is not JSON: "), F.substring(body, 1, 80)))).otherwise(body)
    keep = [F.col(c) for c in fetched.columns if c != doc_col]
    return fetched.filter(body.isNotNull()).select(*keep, parsed.alias(doc_col)).select(*fetched.columns)


LIST_LENGTH = 10        # a leaderboard is asked for from offset 0, this long


def list_head(docs: DataFrame, doc: str, list_path: str, length: int | None, element_schema: str, keep: list[str],
              on_bad: str = D.FAIL) -> DataFrame:
    """A4 consumer side: the first ``length`` entries of a listed array (``None``: all), one row
    each: ``keep``, the 1-based ``entry_rank`` and the entry ``e``."""
    parsed = D.parse(doc, f"struct<{list_path}:array<{element_schema}>>", on_bad)
    head = parsed.getField(list_path)
    if length is not None:
        head = F.slice(head, 1, length)
    return (docs.select(*keep, F.posexplode(head).alias("_pos", "e"))
            .select(*keep, (F.col("_pos") + 1).cast("int").alias("entry_rank"), "e"))


PAGE_SCHEMA = "struct<year:string, month:string, slot:string, days:array<string>>"


def page_entries(pages: DataFrame, doc_col: str = "json_data", on_bad: str = D.FAIL) -> DataFrame:
    """U4: page documents -> one row per day entry.

    Each page is ``{"year", "month", "days": [...]}`` (optional ``slot``); the
    day number is the entry's 1-based position in ``days``.  A JSON null entry
    is a day without a selection: it is no entry, neither counted nor landed.
    """
    p = D.parse(doc_col, PAGE_SCHEMA, on_bad)
    keep = [c for c in pages.columns if c != doc_col]
    return (pages.select(*keep, p.alias("_p"))
            .select(*keep, F.col("_p.year").cast("int").alias("data_year"),
                    F.col("_p.month").cast("int").alias("data_month"),
                    F.coalesce(F.col("_p.slot").cast("bigint"), F.lit(1).cast("bigint")).alias("data_slot"),
                    F.posexplode(F.col("_p.days")).alias("_pos", "json_data"))
            .filter(F.col("json_data").isNotNull())
            .withColumn("data_day", (F.col("_pos") + 1).cast("int")).drop("_pos"))


def paged_feed(spark: SparkSession, transport, n: int | None, land: str | None = None,
               first_round: int = 4, max_pages: int = 10_000, on_bad: str = D.FAIL) -> DataFrame:
    """A1: pages 0, 1, 2 ... (0 = newest) until N day entries are held, then
    the newest N by (page, position from the end).

    The feed ends at the first page that does not exist (no response).  A page
    with an empty ``days`` list is a month without entries and does not end it; a
    page that is not JSON, or has no ``days`` list, fails the walk.  A walk that
    has asked for ``max_pages`` pages and holds neither N entries nor the end of
    the feed fails too, rather than return part of it.

    With a ``TableTransport`` every page is already there (``page_no`` +
    document).  Otherwise pages are read through the ``strata_pages`` data
    source (one input partition per page) in rounds of growing size; each
    round is written to ``land`` so a lost executor never makes the walk
    fetch a page twice, and only the round's entry count and the number of the
    first absent page reach the driver.  Pages that a round fetched beyond the
    end of the feed are left out, so the result does not depend on round sizes.
    """
    end = None
    if isinstance(transport, TableTransport):
        pages = transport.responses.select(F.col(transport.key_cols[0]).alias("page_no"),
                                           F.col(transport.doc_col).alias("json_data"))
    else:
        if land is None:
            raise ValueError("paged_feed over a live transport needs a landing folder")
        days = F.filter(D.parse("json_data", PAGE_SCHEMA, on_bad).getField("days"), lambda d: d.isNotNull())
        lo, size, held, r = 0, first_round, 0, 0
        while end is None and (n is None or held < n):
            if lo >= max_pages:
                raise RuntimeError(f"the feed goes on after {max_pages} pages, with {held} entries held")
            size = min(size, max_pages - lo)
            read_pages(spark, transport, lo, size).write.mode("overwrite").parquet(f"{land}/round={r}")
            got = spark.read.parquet(f"{land}/round={r}")
            end = got.filter("json_data IS NULL").agg(F.min("page_no")).first()[0]
            if end is not None:
                got = got.filter(F.col("page_no") < end)
            count = F.when(days.isNull(), F.raise_error(F.concat(F.lit("a page without a list of days: "), F.col("page_no")))).otherwise(F.size(days))
            held += got.agg(F.sum(count).alias("n")).first()["n"] or 0
            lo, size, r = lo + size, size * 2, r + 1
        pages = spark.read.parquet(f"{land}/round=*").select("page_no", "json_data")
        if end is not None:
            pages = pages.filter(F.col("page_no") < end)
    entries = page_entries(pages, on_bad=on_bad)
    # newest first: smallest page key (0 = this month), then the last day of it
    return newest(entries, n, [F.col("page_no").asc(), F.col("data_day").desc(), F.col("data_slot").asc()]).drop("page_no")
