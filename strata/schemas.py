"""Declared tables of the four layers: types, keys, NOT NULL, text lengths.

Schemas are fixed up front and never inferred.  ``varchar`` lengths are kept
as a separate rule (checked by ``strata.sinks.constraints``) so the stored
Spark type is a plain string.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    dtype: str                 # Spark DDL type: int, string, double, date, boolean, array<int>
    max_len: int | None = None  # VARCHAR(n)
    not_null: bool = False


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...] = ()
    primary: bool = False       # PRIMARY KEY: key columns are also NOT NULL
    extra_not_null: tuple[str, ...] = field(default=())

    @property
    def qualified(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(c.dtype), True)
            for c in self.columns])

    @property
    def ddl(self) -> str:
        """The columns as a catalog declares them: lengths and NOT NULL included."""
        return ", ".join(f"{c.name} {f'varchar({c.max_len})' if c.max_len else c.dtype}"
                         f"{' NOT NULL' if c.name in self.not_null else ''}" for c in self.columns)

    @property
    def not_null(self) -> list[str]:
        cols = [c.name for c in self.columns if c.not_null]
        if self.primary:
            cols += [k for k in self.key if k not in cols]
        return cols + [c for c in self.extra_not_null if c not in cols]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.max_len for c in self.columns if c.max_len}

    def column(self, name: str) -> Col:
        return next(c for c in self.columns if c.name == name)


def _c(name, dtype, n=None, not_null=False):
    return Col(name, dtype, n, not_null)


# ---- collect layer: key columns + the raw JSON text -------------------------
# data_slot numbers several selections on one day (1 for a one-a-day feed).
COLLECT_TMIO = TableSpec("collect", "tmio", (
    _c("data_year", "int"), _c("data_month", "int"), _c("data_day", "int"),
    _c("data_slot", "bigint"), _c("json_data", "string")),
    key=("data_year", "data_month", "data_day", "data_slot"))

COLLECT_TMIO_LEADERBOARDS = TableSpec("collect", "tmio_leaderboards", (
    _c("map_uid", "string", 50), _c("json_data", "string")),
    key=("map_uid",), primary=True)

COLLECT_TMX = TableSpec("collect", "tmx", (
    _c("map_uid", "string", 50), _c("json_data", "string")),
    key=("map_uid",), primary=True)

COLLECT_TMX_AUTHORS = TableSpec("collect", "tmx_authors", (
    _c("track_id", "int"), _c("json_data", "string")),
    key=("track_id",), primary=True)

# ---- conform layer: typed ---------------------------------------------------
CONFORM_TMIO = TableSpec("conform", "tmio", (
    _c("totd_year", "int"), _c("totd_month", "int"), _c("totd_day", "int"),
    _c("map_uid", "string", 50), _c("exchange_id", "int"),
    _c("author_name", "string", 50), _c("author_id", "string", 50),
    _c("author_time", "double"), _c("gold_time", "double"),
    _c("silver_time", "double"), _c("bronze_time", "double"),
    _c("submitter_name", "string", 50), _c("submitter_id", "string", 50),
    _c("uploaded_year", "int"), _c("uploaded_month", "int"), _c("uploaded_day", "int"),
    _c("leaderboard_uid", "string", 50)),
    key=("map_uid",), primary=True)

CONFORM_TMIO_LEADERBOARDS = TableSpec("conform", "tmio_leaderboards", (
    _c("exchange_id", "int", not_null=True), _c("player_name", "string", 50),
    _c("player_id", "string", 50), _c("replay_time", "double"),
    _c("uploaded_year", "int"), _c("uploaded_month", "int"), _c("uploaded_day", "int")),
    key=("exchange_id", "player_id"))

CONFORM_TMX = TableSpec("conform", "tmx", (
    _c("map_uid", "string", 50), _c("track_id", "int"), _c("map_name", "string", 200),
    _c("style_name", "string", 50), _c("difficulty_name", "string", 50),
    _c("map_tags", "array<int>"), _c("laps", "int"),
    _c("uploaded_year", "int"), _c("uploaded_month", "int"), _c("uploaded_day", "int"),
    _c("updated_year", "int"), _c("updated_month", "int"), _c("updated_day", "int")),
    key=("map_uid",), primary=True)

CONFORM_TMX_AUTHORS = TableSpec("conform", "tmx_authors", (
    _c("track_id", "int", not_null=True), _c("username", "string", 50),
    _c("author_role", "string", 50)),
    key=("track_id", "username"))

# ---- consume layer ----------------------------------------------------------
CONSUME_TOTD = TableSpec("consume", "totd", (
    _c("totd_date", "date"), _c("totd_day_of_week", "string", 10),
    _c("exchange_id", "int"), _c("map_name", "string", 200),
    _c("is_multilap_flag", "boolean"), _c("uploaded_date", "date"),
    _c("days_before_totd", "int"),
    _c("author_time", "double"), _c("gold_time", "double"),
    _c("silver_time", "double"), _c("bronze_time", "double"),
    _c("wr_username", "string", 50), _c("wr_user_id", "string", 50),
    _c("wr_replay_time", "double"), _c("wr_uploaded_date", "date")),
    key=("totd_date", "exchange_id"))

CONSUME_TOTD_TAGS = TableSpec("consume", "totd_tags", (
    _c("exchange_id", "int"), _c("tag_name", "string", 50)),
    key=("exchange_id", "tag_name"))

CONSUME_TOTD_AUTHORS = TableSpec("consume", "totd_authors", (
    _c("exchange_id", "int"), _c("username", "string", 50),
    _c("user_id", "string", 50), _c("author_role", "string", 200)),
    key=("exchange_id", "username"))

# ---- reference layer --------------------------------------------------------
REF_TMX_TAGS = TableSpec("ref", "tmx_tags", (
    _c("tag_id", "int"), _c("tag_name", "string", 50, not_null=True)),
    key=("tag_id",), primary=True)

# The map tag catalogue (tag id, tag name) the tag bridge looks
# up.  They must equal the published catalogue for the bridge to name tags
# right, so they are stated as given, in id order.
TMX_TAGS = [
    (1, "Race"), (2, "FullSpeed"), (3, "Tech"), (4, "RPG"), (5, "LOL"),
    (6, "Press Forward"), (7, "SpeedTech"), (8, "MultiLap"), (9, "Offroad"),
    (10, "Trial"), (11, "ZrT"), (12, "SpeedFun"), (13, "Competitive"),
    (14, "Ice"), (15, "Dirt"), (16, "Stunt"), (17, "Reactor"), (18, "Platform"),
    (19, "Slow Motion"), (20, "Bumper"), (21, "Fragile"), (22, "Scenery"),
    (23, "Kacky"), (24, "Endurance"), (25, "Mini"), (26, "Remake"),
    (27, "Mixed"), (28, "Nascar"), (29, "SpeedDrift"), (30, "Minigame"),
    (31, "Obstacle"), (32, "Transitional"), (33, "Grass"), (34, "Backwards"),
    (35, "Freewheel"), (36, "Signature"), (37, "Royal"), (38, "Water"),
    (39, "Plastic"), (40, "Arena"), (41, "Freestyle"), (42, "Educational"),
    (43, "Sausage"), (44, "Bobsleigh"), (45, "Pathfinding"), (46, "FlagRush"),
    (47, "Puzzle"),
]

ALL_TABLES = [
    COLLECT_TMIO, COLLECT_TMIO_LEADERBOARDS, COLLECT_TMX, COLLECT_TMX_AUTHORS,
    CONFORM_TMIO, CONFORM_TMIO_LEADERBOARDS, CONFORM_TMX, CONFORM_TMX_AUTHORS,
    CONSUME_TOTD, CONSUME_TOTD_TAGS, CONSUME_TOTD_AUTHORS, REF_TMX_TAGS,
]


def create_statements(tables: list[TableSpec] | None = None, location: str | None = None) -> list[str]:
    """K6: the statements that declare the layers (databases) and their tables
    in a catalog; with ``location`` (a shared folder) as external tables there."""
    tables = ALL_TABLES if tables is None else tables
    out = [f"CREATE DATABASE IF NOT EXISTS {layer}" for layer in dict.fromkeys(t.layer for t in tables)]
    for t in tables:
        where = f" LOCATION '{location.rstrip('/')}/{t.layer}/{t.name}'" if location else ""
        out.append(f"CREATE TABLE IF NOT EXISTS {t.qualified} ({t.ddl}) USING parquet{where}")
    return out


def create_tables(spark: SparkSession, tables: list[TableSpec] | None = None, location: str | None = None) -> None:
    for statement in create_statements(tables, location):
        spark.sql(statement)


def empty(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """An empty table the optimizer can see is empty (``limit(0)`` becomes an
    empty relation), so joins and unions against it are planned away."""
    return spark.createDataFrame([], spec.struct).limit(0)


def seed_rows(spark: SparkSession, rows=None) -> DataFrame:
    """Inline constant rows of the tag catalogue as a DataFrame."""
    return spark.createDataFrame(rows if rows is not None else TMX_TAGS, REF_TMX_TAGS.struct)
