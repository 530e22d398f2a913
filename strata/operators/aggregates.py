"""Per-group minimum (G1) and arg-min with tie policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIE_ALL = "all"
TIE_FIRST = "first"
TIE_ERROR = "error"


def group_min(df: DataFrame, key: list[str], value: str, alias: str,
              keys: DataFrame | None = None) -> DataFrame:
    """G1 (+J7): least ``value`` per key; only keys present in ``keys`` count.

    A partial + final hash aggregate, so a hot key is combined map-side.
    Catalyst moves the semi join below the aggregate: a key that doesn't count
    is dropped before it is aggregated.
    """
    out = df.groupBy(*key).agg(F.min(value).alias(alias))
    if keys is not None:
        out = out.join(keys.select(*key), key, "left_semi")
    return out


def arg_min(df: DataFrame, key: list[str], value: str, tie: str = TIE_FIRST,
            order: list[Column | str] | None = None, method: str | None = None) -> DataFrame:
    """The rows holding the least ``value`` per key (NULL values never win,
    and a key with a NULL part is no group, as in the aggregate's join back).

    ``tie='all'`` keeps every holder, ``'first'`` keeps one by ``order``
    (after the value), ``'error'`` fails when a key has two holders.
    ``method='window'`` ranks in one shuffle; ``rank``/``row_number = 1`` plans
    a partial WindowGroupLimit before the shuffle, so each map task sends at
    most its own holders of a key.  ``method='join'`` is the aggregate +
    join-back form (J5): a partial minimum, then a join that AQE can split
    when one key is hot.  By default ``tie='all'`` uses the join form (a
    key whose rows all tie would otherwise reach one window task whole) and
    the other policies the window form.
    """
    method = method or ("join" if tie == TIE_ALL else "window")
    base = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [value, *key]]))
    if method == "join":
        mins = base.groupBy(*key).agg(F.min(value).alias("_min"))
        out = base.join(mins, key).filter(F.col(value) == F.col("_min")).drop("_min")
        if tie == TIE_ALL:
            return out
        base = out
    w = Window.partitionBy(*key).orderBy(F.col(value).asc(), *(order or []))
    if tie == TIE_FIRST:
        return base.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    if tie == TIE_ERROR:
        # the second row of a key fails the job if it has the least value too: two rows of a map task's are enough
        w = Window.partitionBy(*key).orderBy(F.col(value).asc())
        two = base.withColumn("_rn", F.row_number().over(w)).withColumn("_rk", F.rank().over(w)).filter("_rn <= 2")
        return (two.filter(F.when((F.col("_rn") == 2) & (F.col("_rk") == 1),
                                  F.raise_error(F.lit("arg_min: several rows hold the minimum")))
                           .otherwise(F.col("_rn") == 1)).drop("_rn", "_rk"))
    return base.withColumn("_rk", F.rank().over(Window.partitionBy(*key).orderBy(F.col(value).asc()))).filter("_rk = 1").drop("_rk")
