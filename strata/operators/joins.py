"""Joins that need more than ``df.join``: the either-key join (J6) and the
size-checked lookup join (J4).  Plain equi, left and two-key joins (J1-J3,
J8) are ``df.join`` as written and need no wrapper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A reference side is broadcast only when this bound on its rows and bytes is proven.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20


def either_key_join(left: DataFrame, right: DataFrame, left_keys: list[str],
                    right_key: str, how: str = "inner") -> DataFrame:
    """``right.k = left.a OR right.k = left.b`` as an equi join.

    Each left row is expanded to its distinct non-null keys, so a row whose two
    keys are equal meets a right row once, and a row with both keys NULL meets
    none.  A right row has one key value, so it meets a left row at most once
    either way: the result is the OR join's bag.  Catalyst then plans a hash
    or sort-merge join (AQE splits a hot key) instead of the nested loop an
    OR condition forces.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("either_key_join supports inner and left_semi")
    k = "_either_key"
    keys = F.array_distinct(F.array_compact(F.array(*[F.col(c) for c in left_keys])))
    expanded = left.withColumn(k, F.explode(keys))
    return expanded.join(right, expanded[k] == right[right_key], how).drop(k)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Bounded size check: reads at most ``max_rows + 1`` rows, and counts them
    and their bytes (fixed-width columns as 8 bytes, others by their text)."""
    width = F.lit(16 + 8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string" or kind.startswith(("varchar", "char", "binary")):
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(df: DataFrame, ref: DataFrame, on, how: str = "inner",
                max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join to a reference table; broadcast it only when proven small in
    rows and bytes, else leave the strategy to the planner (shuffle join)."""
    side = F.broadcast(ref) if is_small(ref, max_rows, max_bytes) else ref
    return df.join(side, on, how)
