import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import scalars as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_strip_codes_is_greedy_three_chars(spark):
    names = ["$fffWhite", "$iWorld", "$s1 Spaced", "end$z", "$$abcX", "plain", None]
    got = one(spark, X.strip_codes("s"), [(n,) for n in names], "s string")
    assert got == ["White", "rld", "$s1 Spaced", "end$z", "$X", "plain", None]


def test_int_list_cases(spark):
    got = one(spark, X.int_list("s"), [("",), (None,), ("7",), ("3, 9",), ("4,4",)], "s string")
    assert got == [[], None, [7], [3, 9], [4, 4]]


def test_int_list_bad_text_fails_when_strict(spark):
    df = spark.createDataFrame([("1,x",)], "s string").select(X.int_list("s"))
    with pytest.raises(Exception):
        df.collect()
    lenient = spark.createDataFrame([("1,x",)], "s string").select(X.int_list("s", strict=False).alias("a"))
    assert lenient.first()["a"] is None


def test_sentinel_blank_flag(spark):
    df = spark.createDataFrame([(0, "", None), (5, "x", 1), (None, None, 3)], "a int, b string, c int")
    got = df.select(X.zero_to_null("a").alias("a"), X.blank_to_null("b").alias("b"),
                    X.greater_flag("c").alias("c")).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (5, "x", False), (None, None, True)]


def test_weekday_padded_to_nine(spark):
    got = one(spark, X.weekday_name(F.to_date("d")), [("2024-01-03",), ("2024-01-05",)], "d string")
    assert got == ["WEDNESDAY", "FRIDAY   "]


def test_build_date_null_part_and_bad_date(spark):
    got = one(spark, X.build_date("y", "m", "d"), [(2024, 2, 29), (2024, None, 1)], "y int, m int, d int")
    assert got == [dt.date(2024, 2, 29), None]
    with pytest.raises(Exception):
        spark.createDataFrame([(2023, 2, 30)], "y int, m int, d int").select(X.build_date("y", "m", "d")).collect()


def test_days_between_is_int(spark):
    df = spark.createDataFrame([("2024-01-10", "2024-01-03")], "a string, b string")
    r = df.select(X.days_between(F.to_date("a"), F.to_date("b")).alias("n"))
    assert r.schema["n"].dataType.simpleString() == "int"
    assert r.first()["n"] == 7


def test_text_to_date_keeps_written_date(spark):
    data = [("2023-01-01T23:30:00+05:00",), ("2023-01-01T23:30:00Z",), ("2023-01-01",), (None,)]
    got = one(spark, X.text_to_date("s"), data, "s string")
    assert got == [dt.date(2023, 1, 1)] * 3 + [None]


def test_ms_to_seconds_from_text(spark):
    got = one(spark, X.ms_to_seconds("s"), [("12345",), ("1.5",), (None,)], "s string")
    assert got == [12.345, 0.0015, None]


def test_pad_fit_cuts_blanks_only(spark):
    got = one(spark, X.pad_fit("s", 3), [("ab   ",), ("abcd",), ("ab",)], "s string")
    assert got == ["ab ", "abcd", "ab"]
