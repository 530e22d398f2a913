"""The correctness gate, run locally: queries() against oracle_sql() in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF01
from strata.plans.checks import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["paged_feed", "resumed_walk", "number_text", "keyed_fetch", "json_unnest", "typed_fields", "strip_codes", "tag_list", "date_functions",
        "tag_lookup", "two_key_left", "either_key_join", "arg_min_ties", "arg_min_first", "group_min",
        "select_days", "select_by_month", "insert_ignore", "upsert_all", "upsert_some", "upsert_bucketed", "constraint_report",
        "quarantine_split", "conform_schema", "incremental_upsert", "daily_fact", "totd_tags", "collect_jobs",
        "arg_min_null_group", "upsert_after_failure", "upsert_hot_key", "constraint_nulls", "wrong_shape_documents",
        "collect_limited", "daily_fact_collisions", "refresh_content", "refresh_roles"]


def canon(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return repr(round(v, 9))
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def norm(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(res.fetchall(), o_cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields][:3] == ["totd_date", "totd_day_of_week", "exchange_id"]
