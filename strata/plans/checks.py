"""Verification queries: each operator run through its library function on
the driver tables (SURVEY section 7.4).  Every query reads whole tables.

The independent SQL formulations live in ``strata.plans.oracles``; column
names and types are kept equal to theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import documents as D
from ..functions import scalars as X
from ..operators.aggregates import TIE_ALL, TIE_FIRST, arg_min, group_min
from ..operators.joins import either_key_join, lookup_join
from ..operators.partitioning import spread
from ..operators.selection import AS_WRITTEN, LATEST, select_days, select_days_by_month, write_by_month
from ..session import scratch_path
from ..sinks import keyed
from ..sinks.changes import pending
from ..sinks.constraints import check_constraints, conform_to, split_violations
from ..sinks.store import TableStore, upsert_buckets
from ..sources import feeds as feed_source
from ..sources.feeds import keyed_fetch, list_head
from ..sources.transports import PageFiles, TableTransport
from ..sources.walk import resumed_feed
from ..streaming.landing import EpochSink, land_increments
from . import encode, jobs


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return encode.read_table(spark, sf, name)


# ---- sources -----------------------------------------------------------------
PAGE_DAYS = 31
NUMBER_BLOCK = 4096


def conversation_pages(conv: DataFrame) -> DataFrame:
    """(page_no, json_data): the newest page (0) is empty, then the
    conversations from the highest id on, at most ``PAGE_DAYS`` turns a page, each
    page led by a null day.  Page numbers run without a gap: a conversation's
    first number is the count of pages before it, summed by blocks of ids."""
    turn = F.struct("turn", F.to_json(F.struct("conv_id", "turn", "role")).alias("day"))
    pages = (conv.withColumn("chunk", F.floor(F.col("turn") / PAGE_DAYS))
             .groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(turn)).alias("l")))
    block = F.floor(F.col("conv_id") / NUMBER_BLOCK).alias("block")
    sizes = pages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "n", block)
    before = lambda part: F.coalesce(
        F.sum("n").over(part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sizes.groupBy("block").agg(F.sum("n").alias("n"))
    ahead = blocks.select("block", before(Window.orderBy(F.col("block").desc())).alias("ahead"))
    first = (sizes.join(ahead, "block")
             .select("conv_id", (F.col("ahead") + before(Window.partitionBy("block").orderBy(F.col("conv_id").desc()))).alias("first")))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("chunk").desc()))
    # a day is kept as the JSON of its turn, so the page's list is written around it
    days = F.concat(F.lit("[null,"), F.array_join(F.transform("l", lambda x: x["day"]), ","), F.lit("]"))
    doc = F.concat(F.lit('{"year": 2000, "month": 1, "days": '), days, F.lit("}"))
    numbered = pages.join(first, "conv_id").select((F.col("first") + place).cast("bigint").alias("page_no"), doc.alias("json_data"))
    empty = conv.sparkSession.createDataFrame([(0, '{"year": 2000, "month": 2, "days": []}')], "page_no bigint, json_data string")
    return numbered.unionByName(empty)


def paged_feed(spark, sf):
    """V01 (A1 U4 L3): the walk over conversations served as pages, one request
    each, through the page source; an empty newest page, null days, newest 50."""
    root = scratch_path(spark, "pages")
    served = PageFiles(f"{root}/served")
    pages = conversation_pages(t(spark, sf, "conversations").select("conv_id", "turn", "role"))
    pages = pages.withColumn("block", F.floor(F.col("page_no") / served.block))
    pages.repartition("block").write.partitionBy("block").parquet(served.path)
    got = feed_source.paged_feed(spark, served, 50, land=f"{root}/landed")
    e = D.parse("json_data", "struct<conv_id:string, turn:string, role:string>")
    return (got.select(e.alias("e"), F.col("data_day").alias("day_number"))
            .select(F.col("e.conv_id").cast("bigint").alias("conv_id"), F.col("e.turn").cast("int").alias("turn"), "e.role", "day_number"))


def month_pages(days: DataFrame) -> DataFrame:
    """(page_no, json_data): a page a month up to the newest month of ``days`` (day, n_orders); a
    month without days is an empty page, a day without orders a null."""
    month = (F.year("day") * 12 + F.month("day") - 1).alias("month")
    span = days.select(month).agg(F.min("month").alias("low"), F.max("month").alias("high"))
    months = span.select("high", F.explode(F.sequence("low", "high")).alias("month"))
    own = days.groupBy(month).agg(F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("day"), "n_orders"))).alias("orders"))
    numbers = F.sequence(F.lit(1), F.coalesce(F.array_max(F.map_keys("orders")), F.lit(0)))
    text = F.transform(F.when(F.col("orders").isNotNull(), numbers).otherwise(F.array().cast("array<int>")), lambda d: F.coalesce(
        F.concat(F.lit('{"n_orders":'), F.try_element_at("orders", d).cast("string"), F.lit("}")), F.lit("null")))
    doc = F.concat(F.lit('{"year": '), F.floor(F.col("month") / 12), F.lit(', "month": '), F.col("month") % 12 + 1,
                   F.lit(', "days": ['), F.array_join(text, ","), F.lit("]}"))
    return months.join(own, "month", "left").select((F.col("high") - F.col("month")).cast("bigint").alias("page_no"), doc.alias("json_data"))


RESUMED_DAYS = 90


def resumed_walk(spark, sf):
    """V01 (A1 U4 L3 ST1): the newest days with their orders, by a walk that is resumed:
    first over the feed as it was some months ago, then over all of it."""
    root = scratch_path(spark, "months")
    days = t(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    last = days.agg(F.max("day")).first()[0]
    got = None
    for part, upto in (("earlier", F.date_sub(F.lit(last), 100)), ("now", F.lit(last))):
        served = PageFiles(f"{root}/{part}", block=1)
        month_pages(days.filter(F.col("day") <= upto)).withColumn("block", F.col("page_no")).write.partitionBy("block").parquet(served.path)
        got = resumed_feed(spark, served, RESUMED_DAYS, f"{root}/walk")
    e = D.parse("json_data", "struct<n_orders:string>")
    return got.select(X.build_date(F.col("data_year"), F.col("data_month"), F.col("data_day")).alias("day"),
                      X.strict_cast(D.field(e, "n_orders"), "bigint").alias("n_orders"))


def keyed_fetch_pages(spark, sf):
    """V02 (A2 A3): one response per key; responses kept in a table are joined."""
    pages = t(spark, sf, "pages").select("page_id", "html")
    return keyed_fetch(pages.select("page_id"), TableTransport(pages, ("page_id",), "html"), ["page_id"], doc_col="html")


LINE_ORDER = ["l_linenumber", "l_suppkey", "l_quantity", "l_shipdate"]


def keyed_list_head(spark, sf):
    """V03 (A4): a listed response per order (served 10 long), first 2 kept."""
    li = t(spark, sf, "lineitem")
    # the server side: each order's list, cut at the length it serves
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    head = li.withColumn("_e", F.row_number().over(w)).filter(F.col("_e") <= encode.LEADERBOARD_LENGTH)
    entry = F.struct("_e", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    docs = (head.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(entry)).alias("lines"))
            .select("l_orderkey", D.to_text(F.struct(F.transform("lines", lambda x: x.dropFields("_e")).alias("lines"))).alias("json_data")))
    got = list_head(docs, "json_data", "lines", 2,
                    "struct<l_linenumber:string, l_suppkey:string, l_quantity:string, l_shipdate:string>", ["l_orderkey"])
    return got.select("l_orderkey", "entry_rank", "e.*").select("l_orderkey", "entry_rank", F.col("l_linenumber").cast("int").alias("l_linenumber"),
                      F.col("l_suppkey").cast("bigint").alias("l_suppkey"),
                      F.col("l_quantity").cast("double").alias("l_quantity"))


EVENT_ELEMENT = "event_id:string, ts:string, user_id:string, event_type:string, value:string, props:string"


def json_rowset(spark, sf):
    """V04 (A5): events as JSON array texts (bounded chunks per user), unnested."""
    ev = t(spark, sf, "events")
    docs = (ev.groupBy("user_id", (F.col("event_id") / 64).cast("bigint").alias("chunk"))
            .agg(D.to_text(F.collect_list(F.struct("event_id", "ts", "user_id", "event_type", "value", "props")))
                 .alias("doc")))
    rows = D.rowset(docs, "doc", EVENT_ELEMENT)
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"),
                       F.col("user_id").cast("bigint").alias("user_id"), "event_type",
                       F.col("value").cast("double").alias("value"),
                       F.col("ts").cast("timestamp_ntz").alias("ts"), "props")


def seed_lookup(spark, sf):
    """V05 (A6 A7): the inline tag catalogue joined to every customer's nation."""
    cust = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("tag_id"))
    return lookup_join(cust, S.seed_rows(spark), "tag_id").select(
        "c_custkey", F.col("tag_id").alias("c_nationkey"), "tag_name")


# ---- documents -----------------------------------------------------------------
def json_fields(spark, sf):
    """V06 (C1-C3): events.props->>'k' as int."""
    ev = t(spark, sf, "events")
    p = D.parse("props", "struct<k:string>")
    return ev.select("event_id", X.strict_cast(D.field(p, "k"), "int").alias("k"))


def number_text(spark, sf):
    """V06 (C2 C3 K7): numbers read as they are written: trailing zeros, exponents,
    more digits than a double holds; beside them strings that look like numbers, quotes and backslashes."""
    li = t(spark, sf, "lineitem")
    key = F.concat_ws("", "l_orderkey", "l_partkey", "l_suppkey")
    written = {"fixed": F.concat(F.col("l_linenumber"), F.lit(".50")), "power": F.concat(F.lit("-"), F.col("l_linenumber"), F.lit("e"), F.col("l_suppkey") % 40),
               "long": F.concat(F.lit("9007199254740993"), key, F.lit(".10"))}
    quoted = F.concat(F.lit('"quoted": "1.50 \\" '), key, F.lit('.0 \\\\"'))
    doc = F.concat(F.lit("{"), *[F.concat(F.lit(f'"{name}": '), text, F.lit(", ")) for name, text in written.items()], quoted, F.lit("}"))
    d = li.select("l_orderkey", "l_linenumber", D.parse(D.numbers_as_text(doc), "struct<fixed:string, power:string, long:string, quoted:string>").alias("j"))
    return d.select("l_orderkey", "l_linenumber", *[D.field("j", f).alias(f) for f in (*written, "quoted")])


def json_roundtrip(spark, sf):
    """V06 (K7 C1-C3): nested record encoded as text and read back."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    doc = D.encode("o_orderkey", F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")).alias("customer"),
                   "o_totalprice", "o_orderdate")
    p = D.parse(doc, "struct<o_orderkey:string, customer:struct<name:string, id:string>, "
                     "o_totalprice:string, o_orderdate:string>")
    d = o.select(p.alias("j"))
    return d.select(X.strict_cast(D.field("j", "o_orderkey"), "bigint").alias("o_orderkey"),
                    D.field("j", "customer.name").alias("c_name"),
                    X.strict_cast(D.field("j", "customer.id"), "bigint").alias("c_custkey"),
                    X.strict_cast(D.field("j", "o_totalprice"), "double").alias("o_totalprice"),
                    X.text_to_date(D.field("j", "o_orderdate")).alias("order_date"))


UNNEST_LINES = 500_000
UNNEST_ELEMENT = "l_linenumber:string, l_suppkey:string, l_quantity:string, l_shipdate:string"


def json_unnest(spark, sf):
    """V07 (U2 U3): line lists as a root array and under a key; orders
    without lines carry [] or NULL and vanish."""
    li = t(spark, sf, "lineitem")
    chunked = spread(li).withColumn("_chunk", (F.monotonically_increasing_id() / 16).cast("bigint"))
    # dealt ahead of the lists, over tasks that grow in number with the lines: none sorts more of them as the table grows
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // UNNEST_LINES))
    chunked = chunked.select("l_orderkey", "_chunk", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate").repartition(tasks, "l_orderkey", "_chunk")
    lists = chunked.groupBy("l_orderkey", "_chunk").agg(
        F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")).alias("l"))
    lined = lists.select("l_orderkey", D.to_text("l").alias("root_doc"),
                         D.to_text(F.struct(F.col("l").alias("tops"))).alias("key_doc"))
    listed = li.select("l_orderkey").repartition(tasks, "l_orderkey")
    empty = (t(spark, sf, "orders").repartition(tasks, "o_orderkey").join(listed, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
             .select(F.col("o_orderkey").alias("l_orderkey"),
                     F.when(F.col("o_orderkey") % 2 == 0, F.lit("[]")).alias("root_doc"),
                     F.when(F.col("o_orderkey") % 2 == 0, F.lit('{"tops": []}'))
                     .when(F.col("o_orderkey") % 3 == 0, F.lit('{"tops": null}')).alias("key_doc")))
    docs = lined.unionByName(empty)
    root = docs.select("l_orderkey", F.lit("root").alias("form"),
                       D.unnest(D.parse("root_doc", f"array<struct<{UNNEST_ELEMENT}>>")).alias("e"))
    under = docs.select("l_orderkey", F.lit("key").alias("form"),
                        D.unnest(D.parse("key_doc", f"struct<tops:array<struct<{UNNEST_ELEMENT}>>>").getField("tops")).alias("e"))
    e = root.unionByName(under)
    return e.select("form", "l_orderkey", D.field("e", "l_linenumber").cast("int").alias("l_linenumber"),
                    D.field("e", "l_suppkey").cast("bigint").alias("l_suppkey"),
                    D.field("e", "l_quantity").cast("double").alias("l_quantity"),
                    X.text_to_date(D.field("e", "l_shipdate")).alias("ship_date"))


# ---- scalars ---------------------------------------------------------------------
def sentinel_null(spark, sf):
    """V08 (P2)."""
    return t(spark, sf, "orders").select(
        "o_orderkey", X.zero_to_null((F.col("o_custkey") % 10).cast("int")).alias("cust_digit"))


def blank_null(spark, sf):
    """V09 (P3)."""
    return t(spark, sf, "orders").select(
        "o_orderkey", X.blank_to_null(F.translate("o_orderstatus", "F", "")).alias("status"))


def three_valued_flag(spark, sf):
    """V10 (P4)."""
    return t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", X.greater_flag(X.zero_to_null(F.col("l_linenumber") % 4), 1).alias("flag"))


def key_fallback(spark, sf):
    """V11 (P5 J2): a left join fills the key a sentinel removed."""
    o = t(spark, sf, "orders")
    left = o.select(F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("map_uid"), "o_orderkey",
                    X.zero_to_null(F.when(F.col("o_orderkey") % 10 == 0, F.lit(0)).otherwise(F.col("o_orderkey")))
                    .alias("exchange_id"))
    right = o.filter(F.col("o_orderkey") % 3 != 0).select(
        F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("map_uid"),
        (F.col("o_orderkey") * 10).alias("track_id"))
    return left.join(right, "map_uid", "left").select("o_orderkey", X.first_key("exchange_id", "track_id").alias("exchange_id"))


def typed_fields(spark, sf):
    """V12 (P6 P7 C9 C10): values through JSON text, cast, ms -> s, date parts."""
    li = t(spark, sf, "lineitem")
    doc = D.encode("l_orderkey", "l_linenumber", "l_extendedprice",
                   F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("shipped"))
    d = li.select(D.parse(doc, "struct<l_orderkey:string, l_linenumber:string, l_extendedprice:string, shipped:string>").alias("j"))
    return d.select(X.strict_cast(D.field("j", "l_orderkey"), "bigint").alias("l_orderkey"),
                    X.strict_cast(D.field("j", "l_linenumber"), "int").alias("l_linenumber"),
                    X.ms_to_seconds(D.field("j", "l_extendedprice")).alias("price_k"),
                    *X.year_month_day(X.text_to_date(D.field("j", "shipped")), "ship"))


STRIP_TAIL = "$iab$z $$abc $iWor"


def strip_codes(spark, sf):
    """V13 (C5)."""
    return t(spark, sf, "part").select(
        "p_partkey", X.strip_codes(F.concat(F.lit("$f0a"), F.col("p_name"), F.lit(STRIP_TAIL))).alias("map_name"))


def tag_list(spark, sf):
    """V14 (C4 U1): comma lists with '' and NULL, cast and unnested."""
    o = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit(None).cast("string"))
            .otherwise(F.concat_ws(", ", (k % 30).cast("string"), (F.col("o_custkey") % 30).cast("string"))))
    return o.select("o_orderkey", D.unnest(X.int_list(text)).alias("tag_id"))


def inner_join_key(spark, sf):
    """V15 (J1): equi join on a text key."""
    o = t(spark, sf, "orders").select(F.concat(F.lit("m"), F.col("o_orderkey").cast("string")).alias("map_uid"),
                                      "o_orderkey", "o_orderpriority")
    li = t(spark, sf, "lineitem").select(F.concat(F.lit("m"), F.col("l_orderkey").cast("string")).alias("map_uid"),
                                         "l_linenumber", "l_quantity")
    return o.join(li, "map_uid").select("o_orderkey", "l_linenumber", "l_quantity", "o_orderpriority")


def date_functions(spark, sf):
    """V16 (C6 C7 C8): dates built from int parts (some NULL), weekday, difference."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    totd = X.build_date(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    up = X.build_date(F.year("l_shipdate"), F.month("l_shipdate"),
                      F.when(F.col("l_linenumber") != 3, F.dayofmonth("l_shipdate")))
    return j.select("l_orderkey", "l_linenumber", totd.alias("totd_date"), X.weekday_name(totd).alias("day_of_week"),
                    up.alias("uploaded_date"), X.days_between(totd, up).alias("days_before"))


# ---- joins -----------------------------------------------------------------------
def tag_lookup(spark, sf):
    """V17 (U1 J4 P8 F1 K1): two ids per part, named via the nation table, one row per name."""
    p = t(spark, sf, "part")
    ids = p.select("p_partkey", D.unnest(F.array((F.col("p_size") % 30).cast("int"),
                                                  (F.col("p_partkey") % 30).cast("int"))).alias("tag_id"))
    named = lookup_join(ids, encode.tag_reference(t(spark, sf, "nation")), "tag_id").select("p_partkey", "tag_name")
    stored = spark.createDataFrame([], "p_partkey bigint, tag_name string").limit(0)
    return keyed.merge_insert_ignore(stored, named, ["p_partkey", "tag_name"], order_by=["tag_name"])


def two_key_left(spark, sf):
    """V18 (J3): left join on two keys; the first grows with the data, so a line
    meets one order at most."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("k"),
                                         (F.col("l_suppkey") % 10).alias("digit"))
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 10).alias("digit"),
                                      "o_custkey", "o_orderstatus")
    return li.join(o, ["k", "digit"], "left").select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus")


def either_key(spark, sf):
    """V19 (J6): o_custkey = c_custkey OR o_orderkey = c_custkey, as an equi join."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = t(spark, sf, "customer").select("c_custkey", "c_name")
    return either_key_join(o, c, ["o_custkey", "o_orderkey"], "c_custkey").select(
        "o_orderkey", "o_custkey", "c_custkey", "c_name")


# ---- aggregates / selection ----------------------------------------------------
def _lines(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")


def arg_min_ties(spark, sf):
    """V20 (G2 J5): every line holding its order's least quantity."""
    return arg_min(_lines(spark, sf), ["l_orderkey"], "l_quantity", TIE_ALL).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


def arg_min_first(spark, sf):
    """V21 (G2): one holder per order, ties by ship date then supplier."""
    return arg_min(_lines(spark, sf), ["l_orderkey"], "l_quantity", TIE_FIRST,
                   order=["l_shipdate", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


def arg_min_null_group(spark, sf):
    """G2 with NULL groups: both methods leave them out."""
    li = _lines(spark, sf).withColumn("l_orderkey", F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")))
    both = [arg_min(li, ["l_orderkey"], "l_quantity", TIE_ALL, method=m).select(F.lit(m).alias("method"), "*") for m in ("window", "join")]
    return both[0].unionByName(both[1]).select("method", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


def group_min_keys(spark, sf):
    """V22 (G1 J7): least quantity per order, only orders that keep an id."""
    keys = t(spark, sf, "orders").select(
        X.zero_to_null(F.when(F.col("o_orderkey") % 10 == 0, F.lit(0)).otherwise(F.col("o_orderkey"))).alias("l_orderkey")
    ).filter(F.col("l_orderkey").isNotNull())
    return group_min(_lines(spark, sf), ["l_orderkey"], "l_quantity", "min_qty", keys)


def select_days_both(spark, sf):
    """V23 (L1 L2): ten days each way from one row per order date."""
    o = t(spark, sf, "orders")
    days = o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                     F.dayofmonth("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))
    a = select_days(days, 10, "y", "m", "d", AS_WRITTEN).select(F.lit(AS_WRITTEN).alias("order_mode"), "*")
    b = select_days(days, 10, "y", "m", "d", LATEST).select(F.lit(LATEST).alias("order_mode"), "*")
    return a.unionByName(b)


def select_orders_by_month(spark, sf):
    """L1, L2 over a stored table: the 50 first orders each way, from the months that hold them."""
    o = t(spark, sf, "orders")
    o = o.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d"),
                 F.col("o_orderkey").cast("long").alias("order_key"))
    path = scratch_path(spark, "orders-by-month")
    write_by_month(o, path, "y", "m")
    stored = spark.read.schema(o.schema).parquet(path)
    each = [select_days_by_month(stored, 50, "y", "m", "d", order, ["order_key"])
            .select(F.lit(order).alias("order_mode"), "y", "m", "d", "order_key") for order in (AS_WRITTEN, LATEST)]
    return each[0].unionByName(each[1])


# ---- sinks -----------------------------------------------------------------------
EVENT_KEY = ["user_id", "event_type"]


def _event_target_batch(spark, sf, cols):
    ev = t(spark, sf, "events").select(*cols)
    stored = spark.createDataFrame([], ev.schema).limit(0)
    target = keyed.merge_insert_ignore(stored, ev.filter(F.col("event_id") < 500), EVENT_KEY, ["event_id"])
    return target, ev.filter(F.col("event_id") >= 500)


def insert_ignore(spark, sf):
    """V24 (K1 J8)."""
    target, batch = _event_target_batch(spark, sf, ["user_id", "event_type", "event_id", "value"])
    return keyed.merge_insert_ignore(target, batch, EVENT_KEY, ["event_id"])


def upsert_all(spark, sf):
    """V25 (K2): the last batch row per key replaces the stored row."""
    target, batch = _event_target_batch(spark, sf, ["user_id", "event_type", "event_id", "value"])
    return keyed.merge_upsert(target, batch, EVENT_KEY, None, keyed.LAST, ["event_id"])


UPSERT_COLS = ["user_id", "event_type", "event_id", "value", "props"]


def upsert_some(spark, sf):
    """V26 (K3): event id and value updated, props frozen at first seen."""
    target, batch = _event_target_batch(spark, sf, UPSERT_COLS)
    return keyed.merge_upsert(target, batch, EVENT_KEY, ["event_id", "value"], keyed.LAST, ["event_id"])


EVENTS_SPEC = S.TableSpec("lake", "events", (
    S.Col("user_id", "bigint"), S.Col("event_type", "string"), S.Col("event_id", "bigint"),
    S.Col("value", "double"), S.Col("props", "string")), key=("user_id", "event_type"))


def upsert_bucketed(spark, sf):
    """V27 (K2 K3 K6): V26 through the bucketed store (8 buckets) in the shared folder."""
    target, batch = _event_target_batch(spark, sf, UPSERT_COLS)
    store = TableStore(spark, scratch_path(spark, "upsert-bucketed"), {EVENTS_SPEC.qualified: 8})
    store.replace(EVENTS_SPEC, target)
    store.upsert(EVENTS_SPEC, batch, ["event_id", "value"], keyed.LAST, ["event_id"])
    return store.read(EVENTS_SPEC)


def upsert_after_failure(spark, sf):
    """V26 after a killed write: its folder, without the commit mark, is in the
    way; it is never read, and the next upsert goes past it."""
    target, batch = _event_target_batch(spark, sf, UPSERT_COLS)
    store = TableStore(spark, scratch_path(spark, "upsert-after-failure"))
    store.replace(EVENTS_SPEC, target)
    left = store._next(EVENTS_SPEC)
    batch.withColumn("props", F.lit("half a write")).write.parquet(left)
    store._remove(f"{left}/_SUCCESS")
    store.upsert(EVENTS_SPEC, batch, ["event_id", "value"], keyed.LAST, ["event_id"])
    return store.read(EVENTS_SPEC)


def upsert_hot_key(spark, sf):
    """K2 where one key holds a third of all rows and a tenth have a NULL key."""
    spec = S.TableSpec("lake", "events_hot", (S.Col("user_id", "bigint"), S.Col("event_type", "string"), S.Col("event_id", "bigint"),
                                              S.Col("value", "double")), key=("user_id", "event_type"))
    k = F.col("event_id")
    ev = t(spark, sf, "events").select(
        F.when(k % 10 == 7, F.lit(None)).when(k % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).cast("bigint").alias("user_id"),
        F.when(k % 3 == 0, F.lit("hot")).otherwise(F.col("event_type")).alias("event_type"), "event_id", "value")
    store = TableStore(spark, scratch_path(spark, "upsert-hot"), {spec.qualified: 8})
    for part in (ev.filter(k < 500), ev.filter(k >= 500)):
        store.upsert(spec, part, None, keyed.LAST, ["event_id"])
    return store.read(spec)


def constraint_nulls(spark, sf):
    """K5: keys with a NULL part are no duplicates, unless NULL is to count as a value."""
    li = t(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")).alias("l_orderkey"), "l_suppkey")
    return (check_constraints(li, key=["l_orderkey", "l_suppkey"], table="append")
            .unionByName(check_constraints(li, key=["l_orderkey", "l_suppkey"], table="match", null_keys=keyed.MATCH)))


def wrong_shape_documents(spark, sf):
    """Documents that are no JSON, or JSON of another shape, are told apart from good ones."""
    k = F.col("o_orderkey")
    forms = ['{"tops": [{"time": "1"}]}', '{"tops": "oops"}', '[{"time": "1"}]', "{not json", "null", '{"tops": [1, 2]}', '{"tops": {"time": 1}}', "{}"]
    doc = F.element_at(F.array(*[F.lit(f) for f in forms]), (k % len(forms) + 1).cast("int"))
    o = t(spark, sf, "orders").select("o_orderkey", doc.alias("doc"), F.when(k % 3 == 0, F.lit('{"error": "not found"}')).otherwise(F.lit("[]")).alias("listed"))

    def status(c, schema):
        return F.when(D.is_bad_json(c), F.lit("bad json")).when(D.is_bad_document(c, schema), F.lit("wrong shape")).otherwise(F.lit("good"))

    return o.select("o_orderkey", status("doc", jobs.LEADERBOARD_DOC).alias("board"), status("listed", jobs.AUTHORS_DOC).alias("authors"))


def constraint_report(spark, sf):
    """V28 (K5): duplicate keys, over-long text, NULL in a NOT NULL column."""
    li = check_constraints(t(spark, sf, "lineitem"), key=["l_orderkey", "l_linenumber"], table="lineitem")
    part = t(spark, sf, "part").select("p_partkey", "p_name", X.zero_to_null(F.col("p_size") % 10).alias("p_size_code"))
    pc = check_constraints(part, key=["p_partkey"], lengths={"p_name": 8}, not_null=["p_size_code"], table="part")
    return li.unionByName(pc)


def quarantine_split(spark, sf):
    """V29 (K5 P7): rows pass or fail with the first reason."""
    p = t(spark, sf, "part")
    size_text = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 7 == 0, F.lit("x")).otherwise(F.lit("")))
    rules = [("p_name longer than 8", F.length("p_name") > 8),
             ("bad size text", X.strict_cast(size_text, "int", strict=False).isNull())]
    out = split_violations(p.select("p_partkey", "p_name", "p_size"), rules)
    return out.select("p_partkey", F.when(F.col("reason").isNull(), F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
                      "reason")


ORDERS_SPEC = S.TableSpec("lake", "orders", (
    S.Col("o_orderkey", "bigint", not_null=True), S.Col("o_custkey", "bigint"),
    S.Col("o_orderstatus", "string", 1), S.Col("o_totalprice", "double"),
    S.Col("o_orderdate", "date"), S.Col("o_orderpriority", "string", 15)), key=("o_orderkey",))


def conform_schema(spark, sf):
    """V30 (K4 K6): text columns in another order -> the declared table."""
    o = t(spark, sf, "orders")
    as_text = o.select(*[F.col(c).cast("string").alias(c) for c in reversed(o.columns)])
    return conform_to(as_text, ORDERS_SPEC)


def incremental_upsert(spark, sf):
    """V31 (ST1): events landed as two files; two availableNow runs upsert
    the last row per key into the store."""
    root = scratch_path(spark, "incremental")
    land, ckpt = f"{root}/landing", f"{root}/checkpoint"
    spec = S.TableSpec("lake", "events_last", (
        S.Col("user_id", "bigint"), S.Col("event_type", "string"),
        S.Col("event_id", "bigint"), S.Col("value", "double")), key=("user_id", "event_type"))
    store = TableStore(spark, f"{root}/lake", {spec.qualified: 8})     # a micro-batch rewrites the buckets it touches
    ev = t(spark, sf, "events").select(*spec.names)

    def sink(batch, epoch_id):
        store.upsert(spec, batch, None, keyed.LAST, ["event_id"])

    for part in (ev.filter(F.col("event_id") < 500), ev.filter(F.col("event_id") >= 500)):
        part.write.mode("append").json(land)
        land_increments(spark, land, spec.struct, sink, ckpt)
    return store.read(spec)


def landing_replay(spark, sf):
    """ST1 K1: events landed in three files, a tenth of them without a user.  The second batch fails
    after its rows are written, and its re-run appends none of them twice."""
    root = scratch_path(spark, "replay")
    land, ckpt = f"{root}/landing", f"{root}/checkpoint"
    spec = S.TableSpec("lake", "events_first", (
        S.Col("user_id", "bigint"), S.Col("event_type", "string"),
        S.Col("event_id", "bigint"), S.Col("value", "double")), key=("user_id", "event_type"))
    sink = EpochSink(TableStore(spark, f"{root}/lake"), spec, "events",
                     lambda store, spec, rows: store.insert_ignore(spec, rows, order_by=["event_id"]))
    ev = t(spark, sf, "events").select(F.when(F.col("event_id") % 10 != 7, F.col("user_id")).alias("user_id"), *spec.names[1:])
    failed = []

    def failing(batch, epoch):
        sink(batch, epoch)
        if epoch == 1 and not failed:
            failed.append(epoch)
            raise RuntimeError("lost after the write, before the commit")

    for part in range(3):
        ev.filter(F.col("event_id") % 3 == part).write.mode("append").json(land)
        try:
            land_increments(spark, land, spec.struct, failing, ckpt)
        except Exception:
            if not failed:
                raise
            land_increments(spark, land, spec.struct, failing, ckpt)
    return sink.read()


# ---- jobs over the encoded feeds ------------------------------------------------
# Upsert targets are bucketed (the layout for large tables).  The bucket
# count comes from the session (``spark.strata.upsertBuckets``, 8 when unset):
# size it so a bucket holds a few hundred MB at the table's target size.
def _upsert_buckets(spark) -> int:
    return int(spark.conf.get("spark.strata.upsertBuckets", "8"))
_REFRESHES: dict = {}


def _refresh(spark, sf, *steps) -> jobs.Refresh:
    """One materialised run of the jobs per (application, data set), in the
    shared folder; each job query runs the steps it needs once and then
    reads the stored layer tables (short lineage, nothing recomputed)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REFRESHES:
        root = scratch_path(spark, "layers")
        store = TableStore(spark, f"{root}/lake", upsert_buckets(_upsert_buckets(spark)))
        _REFRESHES[key] = jobs.Refresh(store, encode.encoded_feeds(spark, sf, f"{root}/feeds"), n=None)
    r = _REFRESHES[key]
    for step in steps:
        if step not in r.done:
            r.run(step)
    return r


def collect_jobs(spark, sf):
    """V32 (X1-X4): the four collect tables; key and one payload field each."""
    r = _refresh(spark, sf, "collect_daily", "collect_map_info", "collect_leaderboards", "collect_authors")
    rd = r.store.read
    tmio = rd(S.COLLECT_TMIO).select(
        F.lit("daily").alias("feed"),
        F.concat_ws("-", "data_year", "data_month", "data_day", "data_slot").alias("key_text"),
        D.path_text("json_data", "map.mapUid").alias("field_text"))
    tmx = rd(S.COLLECT_TMX).select(F.lit("map_info").alias("feed"), F.col("map_uid").alias("key_text"),
                                   D.path_text("json_data", "TrackID").alias("field_text"))
    lb = rd(S.COLLECT_TMIO_LEADERBOARDS).select(
        F.lit("leaderboard").alias("feed"), F.col("map_uid").alias("key_text"),
        F.size(D.parse("json_data", jobs.LEADERBOARD_DOC).getField("tops")).cast("string").alias("field_text"))
    au = rd(S.COLLECT_TMX_AUTHORS).select(
        F.lit("authors").alias("feed"), F.col("track_id").cast("string").alias("key_text"),
        D.path_text("json_data", "[0].Username").alias("field_text"))
    return tmio.unionByName(tmx).unionByName(lb).unionByName(au)


def conform_tmio(spark, sf):
    """V33 (X5)."""
    return _refresh(spark, sf, "conform_daily").store.read(S.CONFORM_TMIO)


def conform_tmx(spark, sf):
    """V34 (X6); the tag array is shown as text."""
    d = _refresh(spark, sf, "conform_map_info").store.read(S.CONFORM_TMX)
    cols = [c for c in S.CONFORM_TMX.names if c != "map_tags"]
    return d.select(*cols, F.array_join(F.transform("map_tags", lambda x: x.cast("string")), ",").alias("map_tags_text"))


def conform_leaderboards(spark, sf):
    """V35 (X7)."""
    return _refresh(spark, sf, "conform_leaderboards").store.read(S.CONFORM_TMIO_LEADERBOARDS)


def conform_authors(spark, sf):
    """V36 (X8)."""
    return _refresh(spark, sf, "conform_authors").store.read(S.CONFORM_TMX_AUTHORS)


def totd_tags(spark, sf):
    """V37 (X10)."""
    return _refresh(spark, sf, "totd_tags").store.read(S.CONSUME_TOTD_TAGS)


def totd_authors(spark, sf):
    """V38 (X11)."""
    return _refresh(spark, sf, "totd_authors").store.read(S.CONSUME_TOTD_AUTHORS)


def daily_fact(spark, sf):
    """V40 (X9): the flagship - daily fact with its record holder."""
    return _refresh(spark, sf, "totd").store.read(S.CONSUME_TOTD)


def daily_fact_all_ties(spark, sf):
    """V40 with ``tie='all'``: every record holder (13,811 rows at sf0.01)."""
    rd = _refresh(spark, sf, "conform_leaderboards").store.read
    return jobs.totd_batch(rd(S.CONFORM_TMX), rd(S.CONFORM_TMIO), rd(S.CONFORM_TMIO_LEADERBOARDS), TIE_ALL)


def daily_fact_collisions(spark, sf):
    """X9 with two maps on every (date, exchange id): the map of smaller uid is kept on request."""
    rd = _refresh(spark, sf, "conform_leaderboards").store.read
    tmx, tmio = rd(S.CONFORM_TMX), rd(S.CONFORM_TMIO)
    again = F.concat(F.lit("z"), F.col("map_uid"))
    tmx = tmx.unionByName(tmx.withColumn("map_uid", again).withColumn("map_name", F.lit("the other map")))
    tmio = tmio.unionByName(tmio.withColumn("map_uid", again))
    return jobs.totd_batch(tmx, tmio, rd(S.CONFORM_TMIO_LEADERBOARDS), on_collision=jobs.COLLIDE_FIRST)


def collect_limited(spark, sf):
    """X1-X4 with N = 25: the newest day entries, and the maps of the days in both orders."""
    n = 25
    r = _refresh(spark, sf, "conform_daily", "conform_map_info")
    tmio, tmx, f = r.store.read(S.CONFORM_TMIO), r.store.read(S.CONFORM_TMX), r.feeds
    daily = jobs.collect_daily_batch(spark, f.daily, n).select(
        F.lit("daily").alias("feed"), F.lit(LATEST).alias("order_mode"), F.col("data_slot").cast("string").alias("key_text"))
    out = [daily]
    for order in (LATEST, AS_WRITTEN):
        for feed, got in (("map_info", jobs.collect_map_info_batch(tmio, f.map_info, n, order)),
                          ("leaderboard", jobs.collect_leaderboards_batch(tmio, f.leaderboards, n, order)),
                          ("authors", jobs.collect_authors_batch(tmio, tmx, f.authors, n, order))):
            got = feed_source.responses(got)
            out.append(got.select(F.lit(feed).alias("feed"), F.lit(order).alias("order_mode"), F.col(got.columns[0]).cast("string").alias("key_text")))
    for o in out[1:]:
        out[0] = out[0].unionByName(o)
    return out[0]


_AGAIN: dict = {}


def _refreshed_again(spark, sf) -> TableStore:
    """A store after a first refresh and a second one over the later feeds."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _AGAIN:
        root = scratch_path(spark, "refreshed-again")
        store = TableStore(spark, f"{root}/lake", upsert_buckets(_upsert_buckets(spark)))
        for later in (False, True):
            jobs.Refresh(store, encode.encoded_feeds(spark, sf, f"{root}/feeds-{later}", later), n=None).run()
            store._remove(f"{root}/feeds-{later}")          # the responses of a run are not asked for again
        _AGAIN[key] = store
    return _AGAIN[key]


def refresh_content(spark, sf):
    """V41 (X12 K1 K3): the fact after a second refresh whose feeds have other
    times, names and payloads: records follow, names, dates and medal times stay."""
    return _refreshed_again(spark, sf).read(S.CONSUME_TOTD)


def refresh_roles(spark, sf):
    """V41 (X8 X11 K1 K2): roles after a second refresh: the conform layer follows, the bridge stays."""
    rd = _refreshed_again(spark, sf).read
    a = rd(S.CONFORM_TMX_AUTHORS).select(F.lit("conform").alias("layer"), F.col("track_id").alias("map_key"), "username", "author_role")
    b = rd(S.CONSUME_TOTD_AUTHORS).select(F.lit("consume").alias("layer"), F.col("exchange_id").alias("map_key"), "username", "author_role")
    return a.unionByName(b)


CHANGED_EVERY = 7
_CHANGED: dict = {}


@dataclass
class WatchedRefresh(jobs.Refresh):
    """A refresh that writes to ``taken``, before it parses them, which leaderboard documents it is about to parse."""
    taken: str = ""

    def conform_leaderboards(self):
        pending(self.store, "conform_leaderboards", S.COLLECT_TMIO_LEADERBOARDS, S.CONFORM_TMIO_LEADERBOARDS,
                self.leaderboard_digests()).write.parquet(self.taken)
        super().conform_leaderboards()


def _refreshed_in_part(spark, sf) -> tuple[TableStore, DataFrame]:
    """A store after a first refresh and a second one in whose feeds one order in
    seven differs, and the leaderboard documents that the second one took in."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CHANGED:
        root = scratch_path(spark, "refreshed-in-part")
        store = TableStore(spark, f"{root}/lake", upsert_buckets(_upsert_buckets(spark)))
        jobs.Refresh(store, encode.encoded_feeds(spark, sf, f"{root}/feeds"), n=None).run()
        store._remove(f"{root}/feeds")
        WatchedRefresh(store, encode.encoded_feeds(spark, sf, f"{root}/feeds-later", True, CHANGED_EVERY), n=None, taken=f"{root}/taken").run()
        store._remove(f"{root}/feeds-later")
        _CHANGED[key] = store, spark.read.parquet(f"{root}/taken").select("map_uid")
    return _CHANGED[key]


def refresh_in_part(spark, sf):
    """The fact after a second refresh that recomputes only what one order in seven reaches."""
    return _refreshed_in_part(spark, sf)[0].read(S.CONSUME_TOTD)


def refresh_changes(spark, sf):
    """The leaderboard documents that such a refresh parses."""
    return _refreshed_in_part(spark, sf)[1]


def whole_leaderboards(spark, sf):
    """Every entry of documents of up to some dozens of entries: those of five successive orders."""
    li = t(spark, sf, "lineitem").withColumn("board", F.expr("CAST(l_orderkey DIV 5 AS INT)"))
    e = F.struct("l_linenumber", F.struct(F.col("l_linenumber").cast("string").alias("name"),
                                          F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("id")).alias("player"),
                 (F.col("l_quantity") * 1000).alias("time"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))
    docs = li.groupBy("board").agg(F.array_sort(F.collect_list(e)).alias("tops")).select(
        F.concat(F.lit("m"), F.col("board").cast("string")).alias("map_uid"), "board", D.to_text(F.struct("tops")).alias("json_data"))
    tmio = docs.select("map_uid", F.col("board").alias("exchange_id"))
    tmx = docs.limit(0).select("map_uid", F.col("board").alias("track_id"))
    return jobs.conform_leaderboards_batch(docs.select("map_uid", "json_data"), tmio, tmx)


def full_refresh(spark, sf):
    """V41 (X12): every job in order through the store, twice; rows per consume table."""
    root = scratch_path(spark, "full-refresh")
    store = TableStore(spark, f"{root}/lake", upsert_buckets(_upsert_buckets(spark)))
    feeds = encode.encoded_feeds(spark, sf, f"{root}/feeds")
    counts = []
    for run in (1, 2):
        jobs.Refresh(store, feeds, n=None).run()
        for spec in (S.CONSUME_TOTD, S.CONSUME_TOTD_TAGS, S.CONSUME_TOTD_AUTHORS):
            counts.append((spec.qualified, run, store.read(spec).count()))
    return spark.createDataFrame(counts, "table_name string, run int, row_count bigint")


QUERIES = {
    "paged_feed": paged_feed,
    "resumed_walk": resumed_walk,
    "keyed_fetch": keyed_fetch_pages,
    "keyed_list_head": keyed_list_head,
    "json_rowset": json_rowset,
    "seed_lookup": seed_lookup,
    "json_fields": json_fields,
    "number_text": number_text,
    "json_roundtrip": json_roundtrip,
    "json_unnest": json_unnest,
    "sentinel_null": sentinel_null,
    "blank_null": blank_null,
    "three_valued_flag": three_valued_flag,
    "key_fallback": key_fallback,
    "typed_fields": typed_fields,
    "strip_codes": strip_codes,
    "tag_list": tag_list,
    "inner_join_key": inner_join_key,
    "date_functions": date_functions,
    "tag_lookup": tag_lookup,
    "arg_min_null_group": arg_min_null_group,
    "upsert_after_failure": upsert_after_failure,
    "upsert_hot_key": upsert_hot_key,
    "constraint_nulls": constraint_nulls,
    "wrong_shape_documents": wrong_shape_documents,
    "collect_limited": collect_limited,
    "daily_fact_collisions": daily_fact_collisions,
    "refresh_content": refresh_content,
    "refresh_roles": refresh_roles,
    "refresh_in_part": refresh_in_part,
    "refresh_changes": refresh_changes,
    "whole_leaderboards": whole_leaderboards,
    "two_key_left": two_key_left,
    "either_key_join": either_key,
    "arg_min_ties": arg_min_ties,
    "arg_min_first": arg_min_first,
    "group_min": group_min_keys,
    "select_days": select_days_both,
    "select_by_month": select_orders_by_month,
    "insert_ignore": insert_ignore,
    "upsert_all": upsert_all,
    "upsert_some": upsert_some,
    "upsert_bucketed": upsert_bucketed,
    "constraint_report": constraint_report,
    "quarantine_split": quarantine_split,
    "conform_schema": conform_schema,
    "incremental_upsert": incremental_upsert,
    "landing_replay": landing_replay,
    "collect_jobs": collect_jobs,
    "conform_tmio": conform_tmio,
    "conform_tmx": conform_tmx,
    "conform_leaderboards": conform_leaderboards,
    "conform_authors": conform_authors,
    "totd_tags": totd_tags,
    "totd_authors": totd_authors,
    "daily_fact": daily_fact,
    "daily_fact_all_ties": daily_fact_all_ties,
    "full_refresh": full_refresh,
}
