import datetime as dt
import random


import pytest
from pyspark.sql import functions as F

from strata.operators import arg_min, either_key_join, group_min, newest, select_days, select_days_by_month, write_by_month
from strata.operators.aggregates import TIE_ALL, TIE_ERROR, TIE_FIRST
from strata.operators.selection import AS_WRITTEN, LATEST
from conftest import rows


def test_either_key_join_equals_or_join(spark):
    rnd = random.Random(42)
    left = [(i, rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, 1, 2, 3, 4, 5])) for i in range(200)]
    right = [(k, "r%d" % k) for k in range(1, 5)]
    L = spark.createDataFrame(left, "id int, a int, b int")
    R = spark.createDataFrame(right, "k int, name string")
    got = rows(either_key_join(L, R, ["a", "b"], "k"), "id", "k")
    want = rows(L.join(R, (L.a == R.k) | (L.b == R.k)), "id", "k")
    assert got == want and len(got) > 0


def test_arg_min_window_equals_join_back(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 20), rnd.choice([None, 1.0, 2.0, 3.0]), i) for i in range(300)]
    d = spark.createDataFrame(data, "g int, v double, i int")
    w = rows(arg_min(d, ["g"], "v", TIE_ALL))
    j = rows(arg_min(d, ["g"], "v", TIE_ALL, method="join"))
    assert w == j
    first = rows(arg_min(d, ["g"], "v", TIE_FIRST, order=["i"]))
    assert len(first) == len({g for g, v, _ in data if v is not None})
    for g, v, i in first:
        assert (v, i) == min((vv, ii) for gg, vv, ii in data if gg == g and vv is not None)


def test_group_min_only_listed_keys(spark):
    d = spark.createDataFrame([(1, 5.0), (1, 2.0), (2, 1.0), (3, None)], "k int, v double")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(group_min(d, ["k"], "v", "m", keys)) == [(1, 2.0), (3, None)]


def test_select_days_as_written_vs_latest(spark):
    dates = [dt.date(2022, 12, 1), dt.date(2023, 1, 3), dt.date(2023, 1, 5), dt.date(2022, 11, 9)]
    d = spark.createDataFrame([(x.year, x.month, x.day) for x in dates], "y int, m int, d int")
    assert rows(select_days(d, 2, "y", "m", "d", AS_WRITTEN)) == [(2022, 11, 9), (2022, 12, 1)]
    assert rows(select_days(d, 2, "y", "m", "d", LATEST)) == [(2023, 1, 3), (2023, 1, 5)]
    assert len(select_days(d, None, "y", "m", "d").collect()) == 4


def test_newest_takes_pages_from_their_end(spark):
    data = [(p, d) for p in range(3) for d in range(1, p + 3)]
    order = [F.col("page").asc(), F.col("day").desc()]
    d = spark.createDataFrame(data, "page int, day int")
    assert rows(newest(d, 4, order)) == [(0, 1), (0, 2), (1, 2), (1, 3)]
    assert len(newest(d, None, order).collect()) == len(data)


def test_arg_min_methods_agree_on_null_groups_and_ties_fail(spark):
    d = spark.createDataFrame([(None, 1.0, 1), (None, 1.0, 2), (1, 2.0, 3), (1, 2.0, 4), (2, 1.0, 5), (2, 3.0, 6)], "g int, v double, i int")
    for tie in (TIE_ALL, TIE_FIRST):
        got = [rows(arg_min(d, ["g"], "v", tie, order=["i"], method=m)) for m in ("window", "join")]
        assert got[0] == got[1] and all(r[0] is not None for r in got[0])
    assert rows(arg_min(d.filter("g = 2"), ["g"], "v", TIE_ERROR)) == [(2, 1.0, 5)]
    with pytest.raises(Exception):
        arg_min(d, ["g"], "v", TIE_ERROR).collect()


def test_spread_is_off_unless_set(spark):
    from strata.operators.partitioning import SETTING, spread
    one = spark.range(10).coalesce(1)
    assert spread(one, 0).rdd.getNumPartitions() == 1 and spread(one, 6).rdd.getNumPartitions() == 6
    spark.conf.set(SETTING, "3")
    try:
        assert spread(one).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(SETTING)


def test_lookup_join_falls_back_to_shuffle_join(spark):
    from strata.operators import lookup_join
    d = spark.createDataFrame([(i, i % 5) for i in range(100)], "id int, k int")
    ref = spark.createDataFrame([(k, "n%d" % k) for k in range(5)], "k int, name string")
    small = lookup_join(d, ref, "k")
    big = lookup_join(d, ref, "k", max_rows=2)      # "too big" to broadcast
    wide = lookup_join(d, ref, "k", max_bytes=40)   # few rows, too many bytes
    assert rows(small) == rows(big) == rows(wide) and len(rows(big)) == 100
    assert "hint" not in wide._jdf.queryExecution().analyzed().toString().lower()
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()


def _by_month(spark, path, rows):
    df = spark.createDataFrame(rows, "y int, m int, d int, k long")
    write_by_month(df, path, "y", "m")
    return df, spark.read.schema(df.schema).parquet(path).select(*df.columns)


def test_months_beyond_the_wanted_rows_are_not_opened(spark, tmp_path):
    days = [(2020 + i // 24, i // 2 % 12 + 1, i % 2 + 1, i) for i in range(72)]            # two days a month, three years
    path = str(tmp_path / "days")
    df, stored = _by_month(spark, path, days)
    for order, kept in ((AS_WRITTEN, {(2020, 1), (2020, 2), (2020, 3)}), (LATEST, {(2022, 12), (2022, 11), (2022, 10)})):
        want = rows(select_days(df, 5, "y", "m", "d", order))
        whole = {f: f.read_bytes() for f in (tmp_path / "days").rglob("*.parquet")
                 if not any(f"y={y}/m={m}/" in str(f) for y, m in kept)}
        for f in whole:                                       # a file that is opened now fails the query
            f.write_bytes(b"no table")
            crc = f.with_name(f".{f.name}.crc")
            if crc.exists():
                crc.unlink()
        assert rows(select_days_by_month(stored, 5, "y", "m", "d", order)) == want
        for f, data in whole.items():
            f.write_bytes(data)


def test_days_by_month_equal_days_of_the_whole_table(spark, tmp_path):
    days = [(y, m, d, 10 * k + (d or 7)) for k, (y, m) in enumerate([(2021, 3), (None, 2), (2021, None), (2020, 12), (2022, 1)]) for d in (1, 1, 2, None)]
    df, stored = _by_month(spark, str(tmp_path / "days"), days)
    for order in (AS_WRITTEN, LATEST):
        for n in (0, 1, 4, 5, 9, 19, 20, 50):
            got, want = (f(x, n, "y", "m", "d", order, ["k"]) for f, x in ((select_days_by_month, stored), (select_days, df)))
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert select_days_by_month(stored, None, "y", "m", "d").count() == 20
    write_by_month(df, str(tmp_path / "days"), "y", "m")                                   # a later write adds to the months
    again = spark.read.schema(df.schema).parquet(str(tmp_path / "days"))
    assert select_days_by_month(again, 3, "y", "m", "d", LATEST, ["k"]).count() == 3 and again.count() == 40
