import pytest
from pyspark.sql import functions as F

from strata.functions import documents as D

DOC = "struct<a:string, b:struct<c:string>, arr:array<struct<v:string>>>"


def parsed(spark, texts, on_bad=D.FAIL):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    return df.select(D.parse("j", DOC, on_bad).alias("p"))


def test_numbers_arrive_as_text_and_objects_nest(spark):
    r = parsed(spark, ['{"a": 12, "b": {"c": "x"}, "arr": [{"v": 1.50}]}']).first()["p"]
    # a number keeps its value, not its spelling (1.50 -> "1.5"): cast, never compare the text
    assert r["a"] == "12" and r["b"]["c"] == "x" and float(r["arr"][0]["v"]) == 1.5


def test_json_null_payload_is_row_of_nulls(spark):
    r = parsed(spark, ["null", None]).collect()
    assert all(x["p"] is None or all(v is None for v in x["p"]) for x in r)


def test_bad_json_fails_or_is_flagged(spark):
    with pytest.raises(Exception):
        parsed(spark, ["{not json"]).collect()
    df = spark.createDataFrame([("{not json",), ('{"a": 1}',), (None,)], "j string")
    assert [r[0] for r in df.select(D.is_bad_json("j")).collect()] == [True, False, False]


def test_unnest_drops_null_and_empty(spark):
    df = spark.createDataFrame([('{"arr": [{"v": 1}, {"v": 2}]}',), ('{"arr": []}',), ('{"arr": null}',), ("{}",)], "j string")
    out = df.select(D.unnest(D.parse("j", DOC).getField("arr")).alias("e"))
    assert sorted(r["e"]["v"] for r in out.collect()) == ["1", "2"]


def test_non_array_under_key_fails(spark):
    with pytest.raises(Exception):
        parsed(spark, ['{"arr": {"v": 1}}']).select(D.unnest(F.col("p.arr"))).collect()


def test_encode_roundtrip_keeps_microseconds(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as ts, 1.25d as v")
    back = df.select(D.encode("ts", "v").alias("t")).select(
        D.parse("t", "struct<ts:string, v:string>").alias("p")).select(
        F.col("p.ts").cast("timestamp_ntz").alias("ts"), F.col("p.v").cast("double").alias("v"))
    assert back.first() == df.first()


def test_rowset_root_array(spark):
    df = spark.createDataFrame([('[{"x": "1", "y": "a"}, {"x": "2"}]',)], "j string")
    out = D.rowset(df, "j", "x:string, y:string")
    assert sorted((r.x, r.y) for r in out.collect()) == [("1", "a"), ("2", None)]


def test_path_text_root_array(spark):
    df = spark.createDataFrame([('[{"Username": "u1"}]',)], "j string")
    assert df.select(D.path_text("j", "[0].Username")).first()[0] == "u1"


def test_numbers_are_read_as_they_are_written(spark):
    cases = [
        ('{"a": 1.50, "b": 1e3}', "1.50", "1e3"), ('{"a":-0.0,"b":12345678901234567890.10}', "-0.0", "12345678901234567890.10"),
        ('{"a": "1.50 \\\\", "b": [1.0, "2.0", -3E+5]}', "1.50 \\", '["1.0","2.0","-3E+5"]'), ('{"a": "x\\"5.0\\"", "b": true}', 'x"5.0"', "true"),
        ('{"a": "\\\\\\"7.0", "b": null}', '\\"7.0', None), ('{"a": "' + "9.0 \\\\ " * 20_000 + '", "b": 2.0}', "9.0 \\ " * 20_000, "2.0"),
        ("{}", None, None), ("null", None, None), (None, None, None), ('{"1.0": 5, "a": 5.00}', "5.00", None),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, j string")
    got = df.select("i", D.parse(D.numbers_as_text("j"), "struct<a:string, b:string>").alias("d")).select("i", "d.a", "d.b").collect()
    assert {r.i: (r.a, r.b) for r in got} == {i: c[1:] for i, c in enumerate(cases)}
    bad = spark.createDataFrame([('{"a": 1.2.3}',), ("<html>1.0",), ("",), ('{"a": 01}',)], "j string")
    assert bad.filter(D.is_bad_json(D.numbers_as_text("j"))).count() == 4


def test_lines_are_dealt_before_they_are_listed(spark, tmp_path, monkeypatch):
    """Tasks grow in number with the lines; an order of many lines is dealt over several."""
    from strata.plans import checks
    spark.range(2_000).selectExpr("IF(id < 1500, 1, id) l_orderkey", "CAST(id AS INT) l_linenumber", "id l_suppkey", "CAST(id AS DOUBLE) l_quantity",
                                  "TIMESTAMP '2020-01-02 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 2).selectExpr("id o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(checks, "UNNEST_LINES", 100)
    got = checks.json_unnest(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 20), REPARTITION_BY_NUM" in plan
    assert got.count() == 4_000 and got.select("form", "l_linenumber").distinct().count() == 4_000
