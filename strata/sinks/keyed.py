"""Keyed writes as DataFrame merges: insert-ignore (K1), upsert (K2) and
upsert of some columns (K3).

Each function returns new table content (``merge_*``) or only the rows to
append (``new_rows``); ``strata.sinks.store`` decides how to write them.

Semantics held:

* a key with a NULL part never clashes, so such rows are appended every run
  (``null_keys='append'``); ``'match'`` treats NULL as a value, ``'reject'`` fails;
* two batch rows on one key: insert-ignore keeps the first by ``order_by``;
  upsert fails (``on_duplicate='error'``) or keeps the first/last by ``order_by``;
* an upserted NULL overwrites the stored value (presence flags, never coalesce);
* K3 leaves the columns outside ``update_cols`` at their first stored value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

APPEND, MATCH, REJECT = "append", "match", "reject"
FIRST, LAST, ERROR = "first", "last", "error"
#: The batch is known to hold one row per key.
UNIQUE = "unique"


def _any_null(key: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


def split_null_keys(df: DataFrame, key: list[str], null_keys: str):
    """Only ``'reject'`` needs a pass of its own; ``'append'`` rows flow
    through the same plan (NULL never matches an equi join) and ``'match'``
    uses null-safe equality."""
    if null_keys == REJECT:
        return df.filter(F.when(_any_null(key), F.raise_error(
            F.lit("NULL in key " + ",".join(key)))).otherwise(F.lit(True)))
    if null_keys not in (APPEND, MATCH):
        raise ValueError(null_keys)
    return df


SALT = "_nullsalt"


def _with_salt(df: DataFrame, key: list[str], null_keys: str, unique: bool) -> DataFrame:
    """Add the ``_nullsalt`` column (``'append'`` only).

    0 for a complete key; for a key with a NULL part a per-row id on the
    batch side (so each such row is its own group and a run of NULL keys
    never lands in one task) and -1 on the stored side.  Grouping and joining
    on (key, salt) is the same as on the key - a NULL key never matches - and
    the join reuses the grouping's hash partitioning, saving a shuffle.
    """
    if null_keys != APPEND:
        return df
    odd = F.monotonically_increasing_id() if unique else F.lit(-1).cast("bigint")
    return df.withColumn(SALT, F.when(_any_null(key), odd).otherwise(F.lit(0).cast("bigint")))


def _group_key(key: list[str], null_keys: str) -> list[str]:
    return key + [SALT] if null_keys == APPEND else list(key)


def _order(order_by: list[Column | str] | None, keep: str) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in (order_by or [])]
    if not cols:
        raise ValueError("keeping one row per key needs order_by")
    if keep == LAST:
        return [c.desc_nulls_last() for c in cols]
    return [c.asc_nulls_last() for c in cols]


def one_per_key(batch: DataFrame, key: list[str], keep: str,
                order_by: list[Column | str] | None = None,
                null_keys: str = MATCH) -> DataFrame:
    """Reduce a batch to one row per key.  ``row_number() = 1`` plans a
    partial WindowGroupLimit before the shuffle, so a hot key sends at most
    one row per map task.  With ``null_keys='append'`` the result keeps the
    ``_nullsalt`` column for the merge join."""
    had_salt = SALT in batch.columns
    if null_keys == APPEND and not had_salt:
        batch = _with_salt(batch, key, null_keys, unique=True)
    part = _group_key(key, null_keys)
    if keep == UNIQUE:
        return batch
    if keep == ERROR:
        # two rows of a key are enough to fail, so a map task sends two at most
        w = Window.partitionBy(*part).orderBy(*part)
        out = (batch.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
               .filter(F.when(F.col("_rn") > 1, F.raise_error(
                   F.lit("batch holds two rows for one key " + ",".join(key)))).otherwise(F.lit(True)))
               .drop("_rn"))
    else:
        w = Window.partitionBy(*part).orderBy(*_order(order_by, keep))
        out = batch.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return out


def keys_twice(rows: DataFrame, key: list[str], null_keys: str = APPEND) -> DataFrame:
    """The keys (columns ``_twice_<key>``) that several rows share.  Only keys are shuffled, counted
    map-side first; a key with a NULL part is no key unless NULL is a value (``'match'``)."""
    keys = rows.select(*key) if null_keys == MATCH else rows.select(*key).dropna()
    return keys.groupBy(*key).count().filter("count > 1").select(*[F.col(k).alias(f"_twice_{k}") for k in key])


def new_rows(target: DataFrame, batch: DataFrame, key: list[str],
             order_by: list[Column | str] | None = None, null_keys: str = APPEND) -> DataFrame:
    """K1 + J8: batch rows to append - first per key, key not stored yet."""
    cols = target.columns
    batch = split_null_keys(batch.select(*cols), key, null_keys)
    first = one_per_key(batch, key, FIRST, order_by, null_keys)
    if null_keys == MATCH:
        stored = target.select(*key)
        cond = reduce(lambda a, b: a & b, [first[k].eqNullSafe(stored[k]) for k in key])
        return first.join(stored, cond, "left_anti")
    stored = _with_salt(target.select(*key), key, null_keys, unique=False)
    # an equi anti join keeps NULL-keyed rows: NULL never matches; the stored keys are held, not sorted
    return first.join(stored.hint("shuffle_hash"), _group_key(key, null_keys), "left_anti").select(*cols)


def merge_insert_ignore(target: DataFrame, batch: DataFrame, key: list[str],
                        order_by: list[Column | str] | None = None,
                        null_keys: str = APPEND) -> DataFrame:
    """K1 as whole new content: stored rows stay, new keys are appended."""
    return target.unionByName(new_rows(target, batch, key, order_by, null_keys))


def merge_upsert(target: DataFrame, batch: DataFrame, key: list[str],
                 update_cols: list[str] | None = None, on_duplicate: str = ERROR,
                 order_by: list[Column | str] | None = None,
                 null_keys: str = APPEND) -> DataFrame:
    """K2 (``update_cols=None``: every non-key column) and K3 (only ``update_cols``).

    A full outer join on the key with presence flags: a key present in both
    takes the batch value for update columns and the stored value for the
    others; a key present on one side keeps that side's row.
    """
    cols = target.columns
    batch = split_null_keys(batch.select(*cols), key, null_keys)
    others = [c for c in cols if c not in key]
    update = set(others if update_cols is None else update_cols)
    b_one = one_per_key(batch, key, on_duplicate, order_by, null_keys)
    tgt = _with_salt(target, key, null_keys, unique=False)
    jk = _group_key(key, null_keys)
    if update == set(others) and null_keys != MATCH:
        # whole rows take the place of stored ones: only the batch's keys are looked up, not its rows
        kept = tgt.join(b_one.select(*jk).hint("shuffle_hash"), jk, "left_anti")
        return kept.select(*cols).unionByName(b_one.select(*cols))
    t = tgt.select(*[F.col(c).alias("t_" + c) if c in others else F.col(c) for c in tgt.columns],
                   F.lit(True).alias("_in_t"))
    b = b_one.select(*[F.col(c).alias("b_" + c) if c in others else F.col(c) for c in b_one.columns],
                     F.lit(True).alias("_in_b"))
    if null_keys == MATCH:
        cond = reduce(lambda a, c: a & c, [t[k].eqNullSafe(b[k]) for k in key])
        j = t.join(b, cond, "full_outer")
        keys = [F.coalesce(t[k], b[k]).alias(k) for k in key]
    else:
        # NULL keys never match, so such rows come through unmatched: appended
        j = t.join(b, jk, "full_outer")
        keys = [F.col(k) for k in key]
    vals = []
    for c in others:
        if c in update:
            vals.append(F.when(F.col("_in_b"), F.col("b_" + c)).otherwise(F.col("t_" + c)).alias(c))
        else:
            vals.append(F.when(F.col("_in_t"), F.col("t_" + c)).otherwise(F.col("b_" + c)).alias(c))
    return j.select(*keys, *vals).select(*cols)
