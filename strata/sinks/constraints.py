"""Typed inserts (K4) and constraint checks (K5).

``conform_to`` turns any frame into a declared table: columns by name, cast
to the declared type (ANSI on, so a bad value fails), VARCHAR(n) blanks cut.
``check_constraints`` reports counts per rule in one aggregate per table;
``split_violations`` routes rows to pass or quarantine with the first reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pad_fit
from ..schemas import TableSpec
from .keyed import APPEND, MATCH

FAIL, QUARANTINE = "fail", "quarantine"


def conform_to(df: DataFrame, spec: TableSpec, strict: bool = True,
               on_violation: str = FAIL) -> DataFrame:
    """K4: select the declared columns by name and cast them.

    ``on_violation='fail'`` fails the job on a bad cast (ANSI), on NULL in a
    NOT NULL column and on text longer than its VARCHAR(n).
    ``'quarantine'`` casts with ``try_cast`` and adds ``reason``: the first
    rule a row breaks (``bad <col>``, ``null <col>``, ``<col> longer than n``),
    NULL when it passes; ``split_violations`` / the runner route on it.
    """
    quarantine = on_violation == QUARANTINE
    out, bad_cast = [], []
    for c in spec.columns:
        src = F.col(c.name)
        v = src.cast(c.dtype) if (strict and not quarantine) else src.try_cast(c.dtype)
        if quarantine:
            bad_cast.append((f"bad {c.name}", src.isNotNull() & v.isNull()))
        if c.max_len:
            v = pad_fit(v, c.max_len)
        out.append(v.alias(c.name))
    if quarantine:
        # a ``_reason`` from the batch (a failed cast inside it) comes first
        upstream = [F.col("_reason")] if "_reason" in df.columns else []
        first_bad = F.coalesce(*upstream, *[F.when(cond, F.lit(msg)) for msg, cond in bad_cast])
        typed = df.select(*out, first_bad.alias("_cast_reason"))
        rules = _reasons(spec)
        later = F.coalesce(*[F.when(cond, F.lit(msg)) for msg, cond in rules]) if rules \
            else F.lit(None).cast("string")
        return typed.select(*spec.names, F.coalesce(F.col("_cast_reason"), later).alias("reason"))
    typed = df.select(*out)
    if on_violation == FAIL:
        bad = _reasons(spec)
        if bad:
            # The check rides on a projected column, not a filter: a filter
            # would be pushed below the projection and re-evaluate the
            # (JSON-parsing) column expressions once per rule.
            # Every column carries its own rules, and the first column all of
            # them, so a narrower selection still checks what it selects.
            def guarded(c: str, rules: list[tuple[str, Column]]) -> Column:
                if not rules:
                    return F.col(c)
                first = F.coalesce(*[F.when(cond, F.lit(msg)) for msg, cond in rules])
                stop = F.raise_error(F.concat(F.lit(spec.qualified + ": "), first))
                return F.when(first.isNotNull(), stop).otherwise(F.col(c)).cast(spec.column(c).dtype).alias(c)

            lead = (list(spec.key) or spec.names)[0]
            own = {c: _reasons(spec, {c: n for k, n in spec.lengths.items() if k == c}, [k for k in spec.not_null if k == c])
                   for c in spec.names}
            typed = typed.select(*[guarded(c, bad if c == lead else own[c]) for c in spec.names])
    return typed


def _reasons(spec: TableSpec, lengths: dict[str, int] | None = None,
             not_null: list[str] | None = None) -> list[tuple[str, Column]]:
    rules = []
    for c in (spec.not_null if not_null is None else not_null):
        rules.append((f"null {c}", F.col(c).isNull()))
    for c, n in (spec.lengths if lengths is None else lengths).items():
        rules.append((f"{c} longer than {n}", F.length(F.col(c)) > n))
    return rules


def check_constraints(df: DataFrame, key: list[str] | None = None,
                      lengths: dict[str, int] | None = None,
                      not_null: list[str] | None = None, table: str = "", null_keys: str = APPEND) -> DataFrame:
    """K5 report: one row per rule with the number of violating rows.

    A key with a NULL part never clashes, so it is no duplicate
    (``null_keys='match'`` counts NULL as a value).

    Length and NOT NULL rules are one global aggregate (partial per task);
    ``duplicate key`` counts rows beyond the first per key, from a grouped
    count that is combined map-side, so a hot key is no problem.
    """
    rules = []
    for c in (not_null or []):
        rules.append((f"null {c}", c, F.col(c).isNull()))
    for c, n in (lengths or {}).items():
        rules.append((f"{c} longer than {n}", c, F.length(F.col(c)) > n))
    parts = []
    if rules:
        agg = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(f"r{i}")
                       for i, (_, _, cond) in enumerate(rules)])
        stack = ", ".join(f"'{name}', '{col}', r{i}" for i, (name, col, _) in enumerate(rules))
        parts.append(agg.selectExpr(f"stack({len(rules)}, {stack}) as (rule, column_name, violations)"))
    if key:
        whole = df if null_keys == MATCH else df.dropna(subset=key)
        dup = (whole.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
               .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
               .select(F.lit("duplicate key").alias("rule"),
                       F.lit(",".join(key)).alias("column_name"), "violations"))
        parts.append(dup)
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(table).alias("table_name"), "rule", "column_name", "violations")


def split_violations(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """K5 routing: adds ``reason`` (first failing rule, NULL = passes)."""
    reason = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules]) if rules \
        else F.lit(None).cast("string")
    return df.withColumn("reason", reason)
