"""Feed encoding: the driver tables re-expressed as API responses.

The collect jobs then run on them exactly as on live responses, and the
oracle checks the consume tables straight from the base tables.  Each
document is bounded in size whatever the data: a page holds at most 31 days,
a leaderboard at most ``LEADERBOARD_LENGTH`` entries, an author list that
plus one, so no key's rows are ever gathered into one unbounded list.

| feed         | from                     | encoding                                                 |
| daily pages  | orders join customer     | one month page per order, the order on its day's place;  |
|              |                          | mapUid 'm'+orderkey, exchangeid 0 when orderkey % 10 = 0  |
| map info     | orders                   | TrackID = orderkey, Tags = orderkey % 30, custkey % 30,   |
|              |                          | Laps absent/1/2 by orderkey % 3, uploaded orderkey % 30   |
|              |                          | days before the order date                               |
| leaderboard  | lineitem join supplier   | per (order, supplier) the least quantity then shipdate;  |
|              |                          | the best 10 per order by (time, date, player id text)    |
| authors      | the same + customer      | (c_name, '') then each listed supplier with returnflag   |
| tag ref      | nation                   | tag_id = n_nationkey, tag_name = n_name                  |
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import documents as D
from ..operators.partitioning import spread
from ..sinks.keyed import FIRST, one_per_key
from ..sinks.store import CODEC
from ..sources.feeds import LIST_LENGTH
from ..sources.live import Feeds
from ..sources.transports import TableTransport

LEADERBOARD_LENGTH = LIST_LENGTH


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored_bytes(scan: DataFrame) -> int:
    """The size of a scan's files, as the planner sees it."""
    return int(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _iso(ts, suffix: str = "") -> F.Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(suffix))


def _document(c) -> F.Column:
    """The text of a record, declared never null (a record's text is not): a filter on it would encode it twice."""
    return F.coalesce(D.to_text(c), F.lit("")).alias("json_data")


def daily_pages(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """(page_no, json_data): page key sorts newest first."""
    # dealt while the rows are narrow: a scan has as few tasks as the table has row groups, and a page is long
    o = orders.join(customer, orders.o_custkey == customer.c_custkey).repartition("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    stamp = (F.when(k % 3 == 0, _iso("o_orderdate", "Z"))
             .when(k % 3 == 1, _iso("o_orderdate", "+05:00"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    player = F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    payload = F.struct(
        F.struct(F.concat(F.lit("m"), k.cast("string")).alias("mapUid"),
                 F.when(k % 10 == 0, F.lit(0).cast("bigint")).otherwise(k).alias("exchangeid"),
                 player.alias("authorplayer"),
                 F.col("o_totalprice").alias("authorScore"),
                 F.col("c_acctbal").alias("goldScore"),
                 F.lit(None).cast("double").alias("bronzeScore"),
                 player.alias("submitterplayer"),
                 stamp.alias("timestamp")).alias("map"),
        F.concat(F.lit("lb"), F.col("o_custkey").cast("string")).alias("leaderboarduid"))
    day = F.dayofmonth("o_orderdate")
    days = F.transform(F.sequence(F.lit(1), day), lambda i: F.when(i == day, payload))
    page = F.struct(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    k.alias("slot"), days.alias("days"))
    page_no = F.struct((-F.year("o_orderdate")).alias("y"), (-F.month("o_orderdate")).alias("m"),
                       (-k).alias("s"))
    return o.select(page_no.alias("page_no"), _document(page))


def map_info(orders: DataFrame) -> DataFrame:
    """(map_uid, json_data)."""
    k = F.col("o_orderkey")
    doc = F.struct(
        k.alias("TrackID"),
        F.concat(F.lit("$f0a"), F.col("o_orderpriority"), F.lit("$iab")).alias("GbxMapName"),
        F.col("o_orderstatus").alias("StyleName"),
        F.col("o_orderpriority").alias("DifficultyName"),
        F.concat_ws(", ", (k % 30).cast("string"), (F.col("o_custkey") % 30).cast("string")).alias("Tags"),
        F.when(k % 3 == 1, F.lit(1)).when(k % 3 == 2, F.lit(2)).alias("Laps"),
        _iso(F.date_sub(F.to_date("o_orderdate"), (k % 30).cast("int"))).alias("UploadedAt"),
        _iso("o_orderdate").alias("UpdatedAt"))
    # dealt by the key that is asked for while the rows are narrow, so that no document is shuffled
    orders = orders.withColumn("map_uid", F.concat(F.lit("m"), k.cast("string"))).repartition("map_uid")
    return orders.select("map_uid", _document(doc))


def leaderboard_rows(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """The listed entries: per order the best ``LEADERBOARD_LENGTH`` players.
    Lines are dealt by order once, for both rankings and for the lists made of them."""
    li = lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag")
    li = li.join(supplier.select("s_suppkey", "s_name"), li.l_suppkey == supplier.s_suppkey).repartition("l_orderkey")
    per_player = one_per_key(li, ["l_orderkey", "l_suppkey"], FIRST, ["l_quantity", "l_shipdate"])
    w = Window.partitionBy("l_orderkey").orderBy("l_quantity", "l_shipdate",
                                                 F.col("l_suppkey").cast("string"))
    return (per_player.withColumn("entry", F.row_number().over(w))
            .filter(F.col("entry") <= LEADERBOARD_LENGTH))


def order_lists(rows: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """(orderkey, tops, own): the listed entries of an order in rank order (null without any), and
    the order's own rows with the names of their customer, if there is one.  The rows come from the ranking
    dealt by order, so the lists are made where they are."""
    tops = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "entry", "s_name", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag"))).alias("tops"))
    names = customer.groupBy("c_custkey").agg(F.collect_list(F.struct("c_name")).alias("names"))
    own = orders.select("o_orderkey", "o_custkey").join(names, F.col("o_custkey") == F.col("c_custkey"), "left")
    own = own.groupBy("o_orderkey").agg(F.collect_list(F.struct("o_custkey", "names")).alias("own"))
    return tops.join(own, F.col("l_orderkey") == F.col("o_orderkey"), "full_outer").select(
        F.coalesce("l_orderkey", "o_orderkey").alias("orderkey"), "tops", "own")


def leaderboards(lists: DataFrame) -> DataFrame:
    """(map_uid, leaderboard_uid, json_data) - ``{"tops": [...]}`` in rank order."""
    # an alias inside a lambda is lost, a named struct is not
    tops = F.transform("tops", lambda x: F.named_struct(
        F.lit("player"), F.named_struct(F.lit("name"), x["s_name"], F.lit("id"), x["l_suppkey"]),
        F.lit("time"), x["l_quantity"] * 1000, F.lit("timestamp"), _iso(x["l_shipdate"], "+00:00")))
    return (lists.filter("tops IS NOT NULL AND own IS NOT NULL")
            .select("orderkey", _document(F.named_struct(F.lit("tops"), tops)), F.explode("own").alias("o"))
            .select(F.concat(F.lit("m"), F.col("orderkey").cast("string")).alias("map_uid"),
                    F.concat(F.lit("lb"), F.col("o.o_custkey").cast("string")).alias("leaderboard_uid"), "json_data"))


def authors(lists: DataFrame) -> DataFrame:
    """(track_id, json_data) - root array of {Username, Role}."""
    entry = lambda name, role: F.named_struct(F.lit("Username"), name, F.lit("Role"), role)
    names = F.flatten(F.transform(F.filter("own", lambda o: o["names"].isNotNull()), lambda o: o["names"]))
    cust = F.transform(F.array_sort(names), lambda n: entry(n["c_name"], F.lit("")))
    sup = F.transform("tops", lambda x: entry(x["s_name"], x["l_returnflag"]))
    none = F.array().cast("array<struct<Username:string,Role:string>>")
    return (lists.select(F.col("orderkey").alias("track_id"), F.concat(F.coalesce(cust, none), F.coalesce(sup, none)).alias("l"))
            .filter(F.size("l") > 0).select("track_id", _document(F.col("l"))))


def tag_reference(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("int").alias("tag_id"), F.col("n_name").alias("tag_name"))


LATER_SECONDS, LATER_ROLE = 7.0, "Tester"


def later_rows(rows: DataFrame) -> DataFrame:
    """The listed entries as a later run finds them: in every third order the
    times of every second player have changed, and every second order's listed
    players have another role."""
    k = F.col("l_orderkey")
    return (rows.withColumn("l_quantity", F.when((k % 3 == 0) & (F.col("l_suppkey") % 2 == 0), F.col("l_quantity") + LATER_SECONDS).otherwise(F.col("l_quantity")))
            .withColumn("l_returnflag", F.when(k % 2 == 0, F.lit(LATER_ROLE)).otherwise(F.col("l_returnflag"))))


class EncodedTransport(TableTransport):
    """A ``TableTransport`` whose responses are made when they are asked for."""

    def __init__(self, made: Callable[[], DataFrame], key_cols: tuple[str, ...], doc_col: str):
        self.made, self.key_cols, self.doc_col = made, key_cols, doc_col

    @property
    def responses(self) -> DataFrame:
        return self.made()


def _landed(build: Callable[[], DataFrame], land: str | None, name: str) -> Callable[[], DataFrame]:
    """``build`` called once, by whichever thread comes first; with ``land`` written there and read back."""
    lock = Lock()

    @cache
    def once() -> DataFrame:
        df = build()
        if land is None:
            return df
        df.write.mode("errorifexists").option("compression", CODEC).parquet(f"{land}/{name}")
        return df.sparkSession.read.parquet(f"{land}/{name}")

    def made() -> DataFrame:
        with lock:
            return once()

    return made


def encoded_feeds(spark: SparkSession, sf_dir: str, land: str | None = None, later: bool = False, every: int = 1) -> Feeds:
    """The four feeds (and the tag reference) over the driver tables; ``later``
    as a later run finds them, with other times, roles, map names and payloads
    (``every``: only of one order in so many).

    With ``land`` (a folder on the shared file system) the listed entries, which two feeds encode, and the
    orders behind the map info are written once, when a job first asks for them, and read back.  The
    responses themselves are encoded as they are asked for: a refresh asks for each feed once and stores what it is given.
    """
    t = lambda n: read_table(spark, sf_dir, n)
    orders, customer = spread(t("orders")), t("customer")
    rows = leaderboard_rows(spread(t("lineitem")), t("supplier"))
    if later:
        own = F.col("l_orderkey") % every == 0
        rows = later_rows(rows.filter(own)).unionByName(rows.filter(~own))
        # a later response of a map or day already stored differs, and must not replace it
        own = F.col("o_orderkey") % every == 0
        orders = (orders.withColumn("o_orderpriority", F.when(own, "renamed").otherwise(F.col("o_orderpriority")))
                  .withColumn("o_totalprice", F.when(own, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))))
    # both the leaderboards and the author lists list these rows
    listed = _landed(lambda: order_lists(rows, orders, customer), land, "_listed")
    described = _landed(lambda: orders, land, "map_info")

    def feed(key_cols: tuple[str, ...], build: Callable[[], DataFrame]) -> TableTransport:
        return EncodedTransport(build, key_cols, "json_data")

    return Feeds(
        daily=feed(("page_no",), lambda: daily_pages(orders, customer)),
        map_info=feed(("map_uid",), lambda: map_info(described())),
        leaderboards=feed(("map_uid", "leaderboard_uid"), lambda: leaderboards(listed())),
        authors=feed(("track_id",), lambda: authors(listed())),
        tags=tag_reference(t("nation")),
        volume=sum(map(stored_bytes, (t("orders"), t("customer"), t("lineitem"), t("supplier")))),
    )
