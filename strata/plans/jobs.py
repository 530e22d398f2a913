"""The jobs X1-X12.

Each ``*_batch`` function is pure: DataFrames in, the batch for one layer
table out, lazily.  ``Refresh`` is the thin runner that reads the current
tables from a ``TableStore``, calls the functions and hands the batches to
the keyed sinks, in the order of a full refresh.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import documents as D
from ..functions import scalars as X
from ..operators.aggregates import TIE_ALL, TIE_ERROR, TIE_FIRST, arg_min
from ..operators.joins import either_key_join, lookup_join
from ..operators.partitioning import spread
from ..operators.selection import LATEST, select_days
from ..sinks import keyed
from ..sinks.changes import Changes, changed
from ..sinks.constraints import QUARANTINE, conform_to
from ..session import scratch_path, shared_dir, shuffles_removed, small_tasks
from ..sinks.store import DIGEST, TableStore
from ..sources.feeds import keyed_fetch, list_head, paged_feed, responses
from ..sources.transports import TableTransport
from ..sources.walk import resumed_feed

# ---- payload schemas (every leaf a string; cast when selected) -------------
_PLAYER = "struct<name:string, id:string>"
TMIO_DOC = (f"struct<map:struct<mapUid:string, exchangeid:string, authorplayer:{_PLAYER}, "
            f"authorScore:string, goldScore:string, silverScore:string, bronzeScore:string, "
            f"submitterplayer:{_PLAYER}, timestamp:string>, leaderboarduid:string>")
TMX_DOC = ("struct<TrackID:string, GbxMapName:string, StyleName:string, DifficultyName:string, "
           "Tags:string, Laps:string, UploadedAt:string, UpdatedAt:string>")
TOP_ENTRY = f"struct<player:{_PLAYER}, time:string, timestamp:string>"
LEADERBOARD_DOC = f"struct<tops:array<{TOP_ENTRY}>>"
AUTHORS_DOC = "array<struct<Username:string, Role:string>>"


# ---- collect (X1-X4) -----------------------------------------------------
def collect_daily_batch(spark: SparkSession, transport, n: int | None,
                        land: str | None = None) -> DataFrame:
    """Newest N day entries of the paged feed -> collect.tmio rows."""
    return paged_feed(spark, transport, n, land).select(*S.COLLECT_TMIO.names)


def latest_maps(tmio: DataFrame, n: int | None, order: str = LATEST) -> DataFrame:
    """L1/L2 over conform.tmio (map_uid breaks ties)."""
    return select_days(tmio, n, "totd_year", "totd_month", "totd_day", order, tiebreak=["map_uid"])


def collect_map_info_batch(tmio: DataFrame, transport, n: int | None, order: str = LATEST,
                           error_col: str | None = None) -> DataFrame:
    """Map info for the latest N maps."""
    keys = latest_maps(tmio, n, order).select("map_uid")
    return keyed_fetch(keys, transport, ["map_uid"], error_col=error_col)


def collect_leaderboards_batch(tmio: DataFrame, transport, n: int | None, order: str = LATEST,
                               error_col: str | None = None) -> DataFrame:
    """Leaderboard heads for the latest N maps (two-part request key)."""
    keys = latest_maps(tmio, n, order).select("map_uid", "leaderboard_uid")
    return keyed_fetch(keys, transport, ["map_uid", "leaderboard_uid"], error_col=error_col,
                       deal_by="map_uid").drop("leaderboard_uid")


def collect_authors_batch(tmio: DataFrame, tmx: DataFrame, transport, n: int | None,
                          order: str = LATEST, error_col: str | None = None) -> DataFrame:
    """Author lists for the latest N maps, keyed by exchange id or track id."""
    j = tmio.join(tmx.select("map_uid", "track_id"), "map_uid")
    keys = latest_maps(j, n, order).select(X.first_key("exchange_id", "track_id").alias("track_id"))
    return keyed_fetch(keys, transport, ["track_id"], error_col=error_col)


# ---- conform (X5-X8) -----------------------------------------------------
def conform_tmio_batch(raw: DataFrame, on_bad: str = D.FAIL) -> DataFrame:
    """Daily selections, typed.  The payload is parsed once."""
    d = raw.select("data_year", "data_month", "data_day", "data_slot",
                   D.parse("json_data", TMIO_DOC, on_bad).alias("j"))
    cast = X.Casts(strict=on_bad == D.FAIL)
    m = lambda p: D.field("j", "map." + p)
    up = cast(m("timestamp"), "date", "uploaded_date")
    return d.select(
        F.col("data_year").alias("totd_year"), F.col("data_month").alias("totd_month"),
        F.col("data_day").alias("totd_day"),
        m("mapUid").alias("map_uid"),
        X.zero_to_null(cast(m("exchangeid"), "int", "exchange_id")).alias("exchange_id"),
        m("authorplayer.name").alias("author_name"), m("authorplayer.id").alias("author_id"),
        (cast(m("authorScore"), "double", "author_time") / 1000).alias("author_time"),
        (cast(m("goldScore"), "double", "gold_time") / 1000).alias("gold_time"),
        (cast(m("silverScore"), "double", "silver_time") / 1000).alias("silver_time"),
        (cast(m("bronzeScore"), "double", "bronze_time") / 1000).alias("bronze_time"),
        m("submitterplayer.name").alias("submitter_name"), m("submitterplayer.id").alias("submitter_id"),
        *X.year_month_day(up, "uploaded"),
        D.field("j", "leaderboarduid").alias("leaderboard_uid"),
        *cast.reason())


def conform_tmx_batch(raw: DataFrame, on_bad: str = D.FAIL) -> DataFrame:
    """Map info, typed; Tags text -> int array."""
    d = raw.select("map_uid", D.parse("json_data", TMX_DOC, on_bad).alias("j"))
    cast = X.Casts(strict=on_bad == D.FAIL)
    f = lambda p: D.field("j", p)
    return d.select(
        "map_uid", cast(f("TrackID"), "int", "track_id").alias("track_id"),
        f("GbxMapName").alias("map_name"), f("StyleName").alias("style_name"),
        f("DifficultyName").alias("difficulty_name"), cast.int_list(f("Tags"), "map_tags").alias("map_tags"),
        cast(f("Laps"), "int", "laps").alias("laps"),
        *X.year_month_day(cast(f("UploadedAt"), "date", "uploaded_date"), "uploaded"),
        *X.year_month_day(cast(f("UpdatedAt"), "date", "updated_date"), "updated"),
        *cast.reason())


def conform_leaderboards_batch(raw: DataFrame, tmio: DataFrame, tmx: DataFrame,
                               on_bad: str = D.FAIL) -> DataFrame:
    """Every leaderboard entry of landed maps; the key is the exchange id, or
    the track id when the map has none (inner join to tmio, left to tmx).  How many
    entries a document has is up to the request."""
    # the ids are held, the documents stream past them unsorted
    j = (raw.join(tmio.select("map_uid", F.col("exchange_id").alias("_ex")).hint("shuffle_hash"), "map_uid")
         .join(tmx.select("map_uid", F.col("track_id").alias("_tr")).hint("shuffle_hash"), "map_uid", "left"))
    keyed_docs = j.select(X.first_key("_ex", "_tr").alias("exchange_id"), "json_data")
    e = list_head(keyed_docs, "json_data", "tops", None, TOP_ENTRY, ["exchange_id"], on_bad)
    cast = X.Casts(strict=on_bad == D.FAIL)
    up = cast(D.field("e", "timestamp"), "date", "uploaded_date")
    return e.select(
        F.col("exchange_id").cast("int").alias("exchange_id"),
        D.field("e", "player.name").alias("player_name"),
        D.field("e", "player.id").alias("player_id"),
        (cast(D.field("e", "time"), "double", "replay_time") / 1000).alias("replay_time"),
        *X.year_month_day(up, "uploaded"),
        *cast.reason())


def conform_authors_batch(raw: DataFrame, on_bad: str = D.FAIL) -> DataFrame:
    """Author list (root array) -> rows; '' role means none."""
    e = raw.select("track_id", D.unnest(D.parse("json_data", AUTHORS_DOC, on_bad)).alias("a"))
    return e.select("track_id", D.field("a", "Username").alias("username"),
                    X.blank_to_null(D.field("a", "Role")).alias("author_role"))


# ---- consume (X9-X11) ----------------------------------------------------
RECORD_AS_WRITTEN = "as_written"
RECORD_COALESCED = "coalesced"


def records(tmio: DataFrame, lead: DataFrame, tie: str = TIE_FIRST,
            record_key: str = RECORD_AS_WRITTEN, method: str | None = None) -> DataFrame:
    """G1 + J7 + G2: record holders per exchange id.

    As written, only exchange ids that some daily selection carries count.
    """
    lead = lead.select("exchange_id", F.col("player_name").alias("wr_username"),
                       F.col("player_id").alias("wr_user_id"),
                       F.col("replay_time").alias("wr_replay_time"),
                       X.build_date("uploaded_year", "uploaded_month", "uploaded_day").alias("wr_uploaded_date"))
    if record_key == RECORD_AS_WRITTEN:
        keys = tmio.select("exchange_id").filter(F.col("exchange_id").isNotNull())
        lead = lead.join(keys, "exchange_id", "left_semi")
    return arg_min(lead, ["exchange_id"], "wr_replay_time", tie,
                   order=["wr_uploaded_date", "wr_user_id"], method=method)


COLLIDE_ERROR, COLLIDE_FIRST = "error", "first"


def touched_facts(base: DataFrame, maps: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``base`` that a change of ``maps`` (map_uid) or of the records of
    ``ids`` (exchange_id) reaches, with the rows of their (date, exchange id), and the
    ids whose records those rows need."""
    parts = ["totd_year", "totd_month", "totd_day"]
    keyed_base = base.withColumn("_key", X.first_key("io_ex", "track_id"))
    by_map = base.join(maps.select("map_uid").distinct(), "map_uid", "left_semi")
    ids = ids.select("exchange_id").filter("exchange_id IS NOT NULL").distinct()
    by_id = [base.join(ids.withColumnRenamed("exchange_id", c), c, "left_semi").select(*base.columns) for c in ("io_ex", "track_id")]
    hit = by_map.select(*base.columns).union(by_id[0]).union(by_id[1]).select(*parts, X.first_key("io_ex", "track_id").alias("_key"), "map_uid")
    keys = hit.select(*parts, "_key").distinct()
    same = reduce(lambda x, c: x & keyed_base[c].eqNullSafe(keys[c]), [*parts, "_key"], F.lit(True))
    found = keyed_base.join(keys, same, "left_semi").drop("_key")
    needed = found.select(F.explode(F.array("io_ex", "track_id")).alias("exchange_id")).filter("exchange_id IS NOT NULL").distinct()
    return found, needed


def totd_batch(tmx: DataFrame, tmio: DataFrame, lead: DataFrame, tie: str = TIE_FIRST,
               record_key: str = RECORD_AS_WRITTEN, method: str | None = None,
               on_collision: str = COLLIDE_ERROR, touched: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One fact row per daily selection with its record holder.

    (tmx join tmio) joined to the records on either key (J6 as an equi join).
    With ``tie='first'`` a map whose two ids both hold a record gives one row:
    least time, then date, then player id.  Two maps on one (date, exchange id)
    stay two rows, which the keyed sink refuses (``on_collision='error'``), or the
    map of smaller uid is kept (``'first'``); rows without a date never collide.

    ``touched`` (map_uid; exchange_id) limits the work to the facts of those maps and of
    maps that can hold a record of those ids, each recomputed from all its
    entries (a time may have risen as well as fallen), and to the facts they could collide with.
    """
    a = tmx.select("map_uid", "track_id", "map_name", "laps",
                   F.col("uploaded_year").alias("x_y"), F.col("uploaded_month").alias("x_m"),
                   F.col("uploaded_day").alias("x_d"))
    b = tmio.select("map_uid", F.col("exchange_id").alias("io_ex"), "totd_year", "totd_month", "totd_day",
                    "author_time", "gold_time", "silver_time", "bronze_time")
    base = a.join(b, "map_uid")
    if touched is not None:
        base, ids = touched_facts(base, *touched)
        lead = lead.join(ids, "exchange_id", "left_semi")
    wr = records(tmio, lead, tie, record_key, method)
    j = either_key_join(base, wr, ["io_ex", "track_id"], "exchange_id")
    totd = X.build_date("totd_year", "totd_month", "totd_day")
    up = X.build_date("x_y", "x_m", "x_d")
    fact = j.select(
        "map_uid", totd.alias("totd_date"), X.weekday_name(totd).alias("totd_day_of_week"),
        X.first_key("io_ex", "track_id").alias("exchange_id"),
        X.strip_codes("map_name").alias("map_name"),
        X.greater_flag("laps", 1).alias("is_multilap_flag"),
        up.alias("uploaded_date"), X.days_between(totd, up).alias("days_before_totd"),
        "author_time", "gold_time", "silver_time", "bronze_time",
        "wr_username", "wr_user_id", "wr_replay_time", "wr_uploaded_date")
    if tie == TIE_FIRST:
        fact = keyed.one_per_key(fact, ["map_uid"], keyed.FIRST, ["wr_replay_time", "wr_uploaded_date", "wr_user_id"])
    if on_collision == COLLIDE_FIRST:
        if tie != TIE_FIRST:
            raise ValueError("on_collision='first' needs tie='first'")
        fact = keyed.one_per_key(fact, ["totd_date", "exchange_id"], keyed.FIRST, ["map_uid"], keyed.APPEND).drop(keyed.SALT)
    elif on_collision != COLLIDE_ERROR:
        raise ValueError(on_collision)
    return fact.drop("map_uid")


def totd_tags_batch(tmx: DataFrame, tags: DataFrame) -> DataFrame:
    """Map tags unnested and named; unknown ids drop out."""
    ids = tmx.select(F.col("track_id").alias("exchange_id"), D.unnest("map_tags").alias("tag_id"))
    return lookup_join(ids, tags.select("tag_id", "tag_name"), "tag_id").select("exchange_id", "tag_name")


def totd_authors_batch(authors: DataFrame, tmio: DataFrame) -> DataFrame:
    """X11: every listed author; the uploader (id and name match) gets a user id."""
    io = tmio.select(F.col("exchange_id").alias("track_id"), F.col("author_name").alias("username"),
                     F.col("author_id").alias("user_id"))
    return (authors.join(io, ["track_id", "username"], "left")
            .select(F.col("track_id").alias("exchange_id"), "username", "user_id", "author_role"))


# ---- runner (X12) --------------------------------------------------------
UPDATE_LEADERBOARD = ["replay_time", "uploaded_year", "uploaded_month", "uploaded_day"]
UPDATE_TOTD = ["wr_username", "wr_user_id", "wr_replay_time", "wr_uploaded_date"]


SET_ASIDE = "set_aside"
NO_ANSWER = "_no_answer"


@dataclass
class Refresh:
    """Every job in order against a ``TableStore``.

    Each step reads the stored layer tables it needs, so every job starts
    from short, materialised lineage (as the scheduled jobs do) instead of
    re-deriving upstream layers.  ``run(until)`` runs a step and the steps it
    depends on; ``run()`` runs the full refresh in the reference order.
    """
    store: TableStore
    feeds: object                        # has daily, map_info, leaderboards, authors, tags
    n: int | None = 10
    order: str = LATEST
    tie: str = TIE_FIRST
    land: str | None = None
    walk: str | None = None              # a shared folder that remembers how far the daily feed has been walked
    on_violation: str = "fail"           # or "quarantine": bad rows go to quarantine/<layer>_<table>
    on_no_answer: str = "fail"           # or "set_aside": keys without an answer go to failed/<layer>_<table>
    changed_only: bool = True            # jobs take in what changed since they last finished; else all that is stored
    done: set = field(default_factory=set)

    ORDER = ("seed_reference", "collect_daily", "conform_daily", "collect_map_info", "conform_map_info",
             "collect_authors", "collect_leaderboards", "conform_authors", "conform_leaderboards",
             "totd", "totd_tags", "totd_authors")
    NEEDS = {
        "seed_reference": (),
        "collect_daily": (),
        "conform_daily": ("collect_daily",),
        "collect_map_info": ("conform_daily",),
        "conform_map_info": ("collect_map_info",),
        "collect_authors": ("conform_daily", "conform_map_info"),
        "collect_leaderboards": ("conform_daily",),
        "conform_authors": ("collect_authors",),
        "conform_leaderboards": ("collect_leaderboards", "conform_daily", "conform_map_info"),
        "totd": ("conform_daily", "conform_map_info", "conform_leaderboards"),
        "totd_tags": ("conform_map_info", "seed_reference"),
        "totd_authors": ("conform_authors", "conform_daily"),
    }

    def _t(self, spec):
        return self.store.read(spec)

    # ---- quarantine mode (K5, P7, C3) ------------------------------------
    @property
    def _quarantining(self) -> bool:
        return self.on_violation == QUARANTINE

    @staticmethod
    def quarantine_spec(spec) -> S.TableSpec:
        """The keyed table of the rows set aside on the way into ``spec``: a
        row that is set aside again by a later run is stored once."""
        return S.TableSpec("quarantine", f"{spec.layer}_{spec.name}", (
            S.Col("table_name", "string"), S.Col("payload", "string"), S.Col("reason", "string")),
            key=("table_name", "payload", "reason"))

    def quarantined(self, spec) -> DataFrame:
        return self.store.read(self.quarantine_spec(spec))

    def _quarantine(self, target, rows: DataFrame, reason) -> None:
        cols = [c for c in rows.columns if c != "reason"]
        self.store.insert_ignore(self.quarantine_spec(target), rows.select(
            F.lit(target.qualified).alias("table_name"), D.to_text(F.struct(*cols)).alias("payload"),
            reason.cast("string").alias("reason")), order_by=["payload"])

    # ---- keys without an answer (A2-A4) ------------------------------------
    @property
    def _reason(self) -> str | None:
        """The column that a fetch gives reasons in; without one, a key without an answer fails the job."""
        if self.on_no_answer not in ("fail", SET_ASIDE):
            raise ValueError(self.on_no_answer)
        return NO_ANSWER if self.on_no_answer == SET_ASIDE else None

    @staticmethod
    def failed_spec(spec) -> S.TableSpec:
        """The keys that the last fetch for ``spec`` got no answer for, each with the
        reason.  They are asked again by the next run, whose own list takes this one's place."""
        return S.TableSpec("failed", f"{spec.layer}_{spec.name}", (
            *[c for c in spec.columns if c.name in spec.key], S.Col("reason", "string")), key=spec.key)

    def failed(self, spec) -> DataFrame:
        return self.store.read(self.failed_spec(spec))

    @contextmanager
    def _changed(self, consumer: str, source, target, current: DataFrame | None = None) -> Iterator[Changes]:
        if self.changed_only:
            with changed(self.store, consumer, source, target, current) as found:
                yield found
        else:
            yield Changes(self.store, source, self.store.digests(source), True)

    def _raw(self, found: Changes, target, schema: str) -> DataFrame:
        """The changed documents, spread for parsing where they come from a scan (those that are
        looked up are dealt by their key).  In quarantine mode the documents
        that are not JSON, or of another shape than ``schema``, are set aside first."""
        raw = spread(found.rows()) if found.whole else found.rows()
        if not self._quarantining:
            return raw
        doc = F.col("json_data")
        bad = D.is_bad_document(doc, schema)
        reason = F.when(D.is_bad_json(doc), F.lit("bad json")).otherwise(F.lit("wrong shape"))
        self._quarantine(target, raw.filter(bad), reason)
        return raw.filter(~bad)

    def _typed(self, batch: DataFrame, target) -> DataFrame:
        """K4 into the target's types; in quarantine mode the batch is
        checkpointed once (reliable, shared folder) and split on ``reason``."""
        if not self._quarantining:
            return conform_to(batch, target)
        shared_dir(self.store.spark)          # checkpoint() writes to spark.checkpoint.dir
        typed = conform_to(batch, target, on_violation=QUARANTINE).checkpoint(eager=True)
        self._quarantine(target, typed.filter(F.col("reason").isNotNull()), F.col("reason"))
        return typed.filter(F.col("reason").isNull()).drop("reason")

    @property
    def _on_bad(self) -> str:
        return D.FLAG if self._quarantining else D.FAIL

    # The full refresh in the reference's order; steps in one group share no
    # table and run side by side (jobs from several driver threads share the
    # cluster, so small stages fill idle cores).
    GROUPS = (("seed_reference", "collect_daily"), ("conform_daily",), ("collect_map_info",), ("conform_map_info",),
              ("collect_authors", "collect_leaderboards"), ("conform_authors", "conform_leaderboards"),
              ("totd", "totd_tags", "totd_authors"))

    def run(self, until: str | None = None, parallel: bool = True) -> "Refresh":
        with shuffles_removed(self.store.spark), small_tasks(self.store.spark, getattr(self.feeds, "volume", 0)):
            return self._run(until, parallel)

    def _run(self, until: str | None, parallel: bool) -> "Refresh":
        if until is None:
            for group in self.GROUPS:
                if parallel and len(group) > 1:
                    with ThreadPoolExecutor(max_workers=len(group)) as pool:
                        for f in [pool.submit(getattr(self, step)) for step in group]:
                            f.result()
                else:
                    for step in group:
                        getattr(self, step)()
                self.done.update(group)
            return self
        for dep in self.NEEDS[until]:
            if dep not in self.done:
                self._run(dep, parallel)
        getattr(self, until)()
        self.done.add(until)
        return self

    # The reference layer, seeded like any keyed table
    def seed_reference(self):
        self.store.insert_ignore(S.REF_TMX_TAGS, conform_to(self.feeds.tags, S.REF_TMX_TAGS), order_by=["tag_name"])

    def _land(self, name: str) -> str:
        """A landing folder of this run's own for one live feed."""
        return f"{self.land or scratch_path(self.store.spark, 'landing')}/{name}-{uuid.uuid4().hex[:8]}"

    # X1
    def collect_daily(self):
        if self.walk is not None and not isinstance(self.feeds.daily, TableTransport):
            b = resumed_feed(self.store.spark, self.feeds.daily, self.n, self.walk).select(*S.COLLECT_TMIO.names)
        else:
            b = collect_daily_batch(self.store.spark, self.feeds.daily, self.n,
                                    None if isinstance(self.feeds.daily, TableTransport) else self._land("daily"))
        self.store.insert_ignore(S.COLLECT_TMIO, conform_to(b, S.COLLECT_TMIO), order_by=["json_data"])

    # X5
    def conform_daily(self):
        with self._changed("conform_daily", S.COLLECT_TMIO, S.CONFORM_TMIO) as found:
            if found.any or not self.store.exists(S.CONFORM_TMIO):
                b = self._typed(conform_tmio_batch(self._raw(found, S.CONFORM_TMIO, TMIO_DOC), self._on_bad), S.CONFORM_TMIO)
                self.store.insert_ignore(S.CONFORM_TMIO, b, order_by=["totd_year", "totd_month", "totd_day", "author_id"])

    def _landed(self, fetched: DataFrame, transport, name: str, spec) -> DataFrame:
        """Responses of a live transport are written once before any sink
        reads them: a recomputed task must not fetch a different answer.  Each
        body is parsed before it is landed, and the landed rows obey the collect
        table's declaration; in quarantine mode bad bodies and rows are set aside."""
        reason = self._reason
        if reason is not None:
            body = F.col("json_data")
            if not self._quarantining:           # there, a body that is not JSON is a quarantined row
                fetched = (fetched.withColumn(reason, F.coalesce(reason, F.when(D.is_bad_json(body), F.concat(
                    F.lit("the response is not JSON: "), F.substring(body, 1, 80)))))
                    .withColumn("json_data", F.when(F.col(reason).isNull(), body)))
            fetched = fetched.filter(body.isNotNull() | F.col(reason).isNotNull())
        elif self._quarantining:
            fetched = fetched.filter(F.col("json_data").isNotNull())
        else:
            fetched = responses(fetched)
        if not isinstance(transport, TableTransport):
            path = self._land(name)
            fetched.write.mode("errorifexists").parquet(path)
            fetched = self.store.spark.read.schema(fetched.schema).parquet(path)
        if reason is not None:
            failed = fetched.filter(F.col(reason).isNotNull()).select(*spec.key, F.col(reason).alias("reason"))
            self.store.replace(self.failed_spec(spec), conform_to(keyed.one_per_key(failed, list(spec.key), keyed.FIRST, ["reason"]).select(
                *spec.key, "reason"), self.failed_spec(spec)))
            fetched = fetched.filter(F.col(reason).isNull()).drop(reason)
        if self._quarantining:
            bad = D.is_bad_json(F.col("json_data"))
            self._quarantine(spec, fetched.filter(bad), F.lit("bad json"))
            return self._typed(fetched.filter(~bad), spec)
        return conform_to(fetched, spec)

    # X2
    def collect_map_info(self):
        b = collect_map_info_batch(self._t(S.CONFORM_TMIO), self.feeds.map_info, self.n, self.order, self._reason)
        self.store.insert_ignore(S.COLLECT_TMX, self._landed(b, self.feeds.map_info, "map_info", S.COLLECT_TMX),
                                 order_by=["json_data"])

    # X6
    def conform_map_info(self):
        with self._changed("conform_map_info", S.COLLECT_TMX, S.CONFORM_TMX) as found:
            if found.any or not self.store.exists(S.CONFORM_TMX):
                b = self._typed(conform_tmx_batch(self._raw(found, S.CONFORM_TMX, TMX_DOC), self._on_bad), S.CONFORM_TMX)
                self.store.insert_ignore(S.CONFORM_TMX, b, order_by=["track_id"])

    # X4
    def collect_authors(self):
        b = collect_authors_batch(self._t(S.CONFORM_TMIO), self._t(S.CONFORM_TMX), self.feeds.authors, self.n, self.order,
                                  self._reason)
        self._upsert_changes(S.COLLECT_TMX_AUTHORS, self._landed(b, self.feeds.authors, "authors", S.COLLECT_TMX_AUTHORS))

    # X3
    def collect_leaderboards(self):
        b = collect_leaderboards_batch(self._t(S.CONFORM_TMIO), self.feeds.leaderboards, self.n, self.order, self._reason)
        self._upsert_changes(S.COLLECT_TMIO_LEADERBOARDS,
                             self._landed(b, self.feeds.leaderboards, "leaderboards", S.COLLECT_TMIO_LEADERBOARDS))

    def _upsert_changes(self, spec, batch: DataFrame) -> None:
        """K2 of the documents that are not stored as they are; the check for two
        documents on one key comes first."""
        if self.store.exists(spec):
            batch = self.store.changes_only(spec, keyed.one_per_key(batch, list(spec.key), keyed.ERROR))
        self.store.upsert(spec, batch)                  # a first load checks its keys itself

    # X8
    def conform_authors(self):
        with self._changed("conform_authors", S.COLLECT_TMX_AUTHORS, S.CONFORM_TMX_AUTHORS) as found:
            if found.any or not self.store.exists(S.CONFORM_TMX_AUTHORS):
                raw = self._raw(found, S.CONFORM_TMX_AUTHORS, AUTHORS_DOC)
                b = self._typed(conform_authors_batch(raw, self._on_bad), S.CONFORM_TMX_AUTHORS)
                self.store.upsert(S.CONFORM_TMX_AUTHORS, b, update_cols=["author_role"])

    def leaderboard_digests(self) -> DataFrame:
        """Of each leaderboard document with a daily selection: its digest and the exchange id it stands for."""
        ids = (self._t(S.CONFORM_TMIO).select("map_uid", F.col("exchange_id").alias("_ex"))
               .join(self._t(S.CONFORM_TMX).select("map_uid", F.col("track_id").alias("_tr")), "map_uid", "left")
               .select("map_uid", X.first_key("_ex", "_tr").alias("_id")))
        return self.store.digests(S.COLLECT_TMIO_LEADERBOARDS).join(ids, "map_uid").select(
            "map_uid", F.concat_ws(" ", DIGEST, F.col("_id").cast("string")).alias(DIGEST))

    # A document's key comes from two other tables, so it is part of what can change
    def conform_leaderboards(self):
        tmio, tmx, current = self._t(S.CONFORM_TMIO), self._t(S.CONFORM_TMX), self.leaderboard_digests()
        with self._changed("conform_leaderboards", S.COLLECT_TMIO_LEADERBOARDS, S.CONFORM_TMIO_LEADERBOARDS, current) as found:
            if found.any or not self.store.exists(S.CONFORM_TMIO_LEADERBOARDS):
                b = conform_leaderboards_batch(self._raw(found, S.CONFORM_TMIO_LEADERBOARDS, LEADERBOARD_DOC), tmio, tmx, self._on_bad)
                self.store.upsert(S.CONFORM_TMIO_LEADERBOARDS, self._typed(b, S.CONFORM_TMIO_LEADERBOARDS),
                                  update_cols=UPDATE_LEADERBOARD)

    # Only the facts that a changed map or a changed record reaches
    def totd(self):
        first = not self.store.exists(S.CONSUME_TOTD) or not self.changed_only
        with self._changed("totd_maps", S.CONFORM_TMX, S.CONSUME_TOTD) as tmx, \
                self._changed("totd_days", S.CONFORM_TMIO, S.CONSUME_TOTD) as tmio, \
                self._changed("totd_records", S.CONFORM_TMIO_LEADERBOARDS, S.CONSUME_TOTD) as lead:
            if not (first or tmx.any or tmio.any or lead.any):
                return
            touched = None
            if not first:
                days = tmio.rows().select("map_uid", "exchange_id")
                # a day's exchange id makes that id's entries count, for other maps too
                touched = (tmx.keys.select("map_uid").union(days.select("map_uid")),
                           lead.keys.select("exchange_id").union(days.select("exchange_id")))
            b = totd_batch(self._t(S.CONFORM_TMX), self._t(S.CONFORM_TMIO), self._t(S.CONFORM_TMIO_LEADERBOARDS), self.tie, touched=touched)
            self.store.upsert(S.CONSUME_TOTD, self._typed(b, S.CONSUME_TOTD), update_cols=UPDATE_TOTD)

    # New maps, or every map when the catalogue has changed
    def totd_tags(self):
        with self._changed("totd_tags", S.CONFORM_TMX, S.CONSUME_TOTD_TAGS) as maps, \
                self._changed("totd_tags_catalogue", S.REF_TMX_TAGS, S.CONSUME_TOTD_TAGS) as tags:
            if maps.any or tags.any or not self.store.exists(S.CONSUME_TOTD_TAGS):
                tmx = self._t(S.CONFORM_TMX) if tags.any else maps.rows()
                b = self._typed(totd_tags_batch(tmx, self._t(S.REF_TMX_TAGS)), S.CONSUME_TOTD_TAGS)
                self.store.insert_ignore(S.CONSUME_TOTD_TAGS, b, order_by=["exchange_id"])

    # X11: a stored author keeps the user id of the first run, so only changed authors matter
    def totd_authors(self):
        with self._changed("totd_authors", S.CONFORM_TMX_AUTHORS, S.CONSUME_TOTD_AUTHORS) as found:
            if found.any or not self.store.exists(S.CONSUME_TOTD_AUTHORS):
                b = self._typed(totd_authors_batch(found.rows(), self._t(S.CONFORM_TMIO)), S.CONSUME_TOTD_AUTHORS)
                self.store.insert_ignore(S.CONSUME_TOTD_AUTHORS, b, order_by=["user_id", "author_role"])


__all__ = ["Refresh", "TIE_ALL", "TIE_ERROR", "TIE_FIRST"]
