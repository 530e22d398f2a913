import pytest
from pyspark.sql import functions as F

from strata import schemas as S
from strata.session import DEALT_BYTES, PARTITION_BYTES, SCAN_BYTES, small_tasks
from strata.sinks import keyed
from strata.sinks.constraints import check_constraints, conform_to, split_violations
from strata.sinks.store import TableStore
from strata.sources.feeds import keyed_fetch
from strata.sources.transports import TableTransport
from conftest import rows

SCHEMA = "k int, v string, w int"


def df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_insert_ignore_keeps_stored_and_first_of_batch(spark):
    target = df(spark, [(1, "old", 0)])
    batch = df(spark, [(1, "new", 1), (2, "b", 5), (2, "a", 3)])
    out = keyed.merge_insert_ignore(target, batch, ["k"], ["w"])
    assert rows(out) == [(1, "old", 0), (2, "a", 3)]


def test_insert_ignore_null_keys_append_every_run(spark):
    target = df(spark, [(None, "x", 0)])
    batch = df(spark, [(None, "x", 0), (None, "y", 1)])
    out = keyed.merge_insert_ignore(target, batch, ["k"], ["w"])
    assert len(out.collect()) == 3
    matched = keyed.merge_insert_ignore(target, batch, ["k"], ["w"], null_keys=keyed.MATCH)
    assert len(matched.collect()) == 1


def test_null_keys_reject(spark):
    with pytest.raises(Exception):
        keyed.merge_insert_ignore(df(spark, []), df(spark, [(None, "x", 0)]), ["k"], ["w"],
                                  null_keys=keyed.REJECT).collect()


def test_upsert_all_and_some(spark):
    target = df(spark, [(1, "t1", 10), (2, "t2", 20)])
    batch = df(spark, [(2, None, 21), (3, "b3", 30)])
    full = keyed.merge_upsert(target, batch, ["k"])
    assert rows(full) == [(1, "t1", 10), (2, None, 21), (3, "b3", 30)]   # upserted NULL overwrites
    some = keyed.merge_upsert(target, batch, ["k"], update_cols=["w"])
    assert rows(some) == [(1, "t1", 10), (2, "t2", 21), (3, "b3", 30)]    # v frozen at first value


def test_upsert_duplicate_policy(spark):
    batch = df(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(Exception):
        keyed.merge_upsert(df(spark, []), batch, ["k"]).collect()
    last = keyed.merge_upsert(df(spark, []), batch, ["k"], on_duplicate=keyed.LAST, order_by=["w"])
    assert rows(last) == [(1, "b", 2)]


def test_sinks_are_idempotent(spark):
    target = df(spark, [(1, "t1", 10)])
    batch = df(spark, [(1, "b1", 11), (2, "b2", 20)])
    once = keyed.merge_upsert(target, batch, ["k"], update_cols=["w"])
    twice = keyed.merge_upsert(once, batch, ["k"], update_cols=["w"])
    assert rows(once) == rows(twice)
    i1 = keyed.merge_insert_ignore(target, batch, ["k"], ["w"])
    assert rows(i1) == rows(keyed.merge_insert_ignore(i1, batch, ["k"], ["w"]))


def test_insert_ignore_equals_anti_join_plus_append(spark):
    import random
    rnd = random.Random(7)
    t = [(rnd.randint(0, 30), str(i), i) for i in range(40)]
    t = list({r[0]: r for r in t}.values())
    b = [(rnd.choice([None] + list(range(50))), "b%d" % i, 100 + i) for i in range(120)]
    out = keyed.merge_insert_ignore(df(spark, t), df(spark, b), ["k"], ["w"])
    stored = {r[0] for r in t}
    first = {}
    nulls = []
    for r in sorted(b, key=lambda r: r[2]):
        if r[0] is None:
            nulls.append(r)
        elif r[0] not in stored and r[0] not in first:
            first[r[0]] = r
    expect = sorted(t + list(first.values()) + nulls, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    got = sorted(out.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [tuple(r) for r in got] == expect


def test_store_snapshot_and_bucketed_agree(spark, tmp_lake):
    spec = S.TableSpec("t", "kv", (S.Col("k", "int"), S.Col("v", "string"), S.Col("w", "int")), key=("k",))
    first = df(spark, [(i, "v%d" % i, i) for i in range(50)] + [(None, "n", 0)])
    batch = df(spark, [(i, "u%d" % i, 100 + i) for i in range(40, 60)] + [(None, "n2", 1)])
    snap = TableStore(spark, tmp_lake + "/snap")
    buck = TableStore(spark, tmp_lake + "/buck", {spec.qualified: 4})
    for st in (snap, buck):
        st.replace(spec, first)
        st.upsert(spec, batch, update_cols=["w"])
        st.insert_ignore(spec, df(spark, [(70, "x", 1), (1, "no", 1)]), order_by=["w"])
    a, b = rows(snap.read(spec)), rows(buck.read(spec))
    assert a == b
    assert (45, "v45", 145) in a and (70, "x", 1) in a and (1, "v1", 1) in a
    assert len([r for r in a if r[0] is None]) == 2


def test_conform_to_casts_and_checks_lengths(spark):
    spec = S.TableSpec("t", "x", (S.Col("a", "int", not_null=True), S.Col("s", "string", 3)), key=("a",))
    ok = spark.createDataFrame([("ab   ", "7")], "s string, a string")
    assert conform_to(ok, spec).first() == (7, "ab ")
    with pytest.raises(Exception):
        conform_to(spark.createDataFrame([("1", "abcd")], "a string, s string"), spec).collect()
    with pytest.raises(Exception):
        conform_to(spark.createDataFrame([(None, "a")], "a string, s string"), spec).collect()
    with pytest.raises(Exception):
        conform_to(spark.createDataFrame([("x1", "a")], "a string, s string"), spec).collect()


def test_check_constraints_and_split(spark):
    d = spark.createDataFrame([(1, "abc"), (1, "abcdef"), (None, "a")], "k int, s string")
    rep = {r.rule: r.violations for r in check_constraints(d, ["k"], {"s": 4}, ["k"]).collect()}
    assert rep == {"null k": 1, "s longer than 4": 1, "duplicate key": 1}
    out = split_violations(d, [("long", F.length("s") > 4), ("nokey", F.col("k").isNull())])
    assert sorted((r.s, r.reason) for r in out.collect()) == [("a", "nokey"), ("abc", None), ("abcdef", "long")]


KV = S.TableSpec("t", "kv", (S.Col("k", "int"), S.Col("v", "string"), S.Col("w", "int")), key=("k",))


def folders(st, spec):
    return sorted(n for n in st._names(st.path(spec)) if n.startswith("v="))


@pytest.mark.parametrize("buckets", [0, 4])
def test_replace_may_read_its_own_table_and_old_versions_go(spark, tmp_lake, buckets):
    st = TableStore(spark, tmp_lake, {KV.qualified: buckets})
    st.replace(KV, df(spark, [(1, "a", 1)]))
    for _ in range(4):
        st.replace(KV, st.read(KV).unionByName(df(spark, [(2, "b", 2)])).dropDuplicates(["k"]))
    assert rows(st.read(KV)) == [(1, "a", 1), (2, "b", 2)] and len(folders(st, KV)) == 2


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_killed_write_is_never_read_and_never_in_the_way(spark, tmp_lake, buckets):
    st = TableStore(spark, tmp_lake, {KV.qualified: buckets})
    st.replace(KV, df(spark, [(1, "a", 1)]))
    left = st._next(KV)
    df(spark, [(9, "half", 9)]).write.parquet(left)
    st._remove(left + "/_SUCCESS")
    assert rows(st.read(KV)) == [(1, "a", 1)]
    st.upsert(KV, df(spark, [(2, "b", 2)]))
    st.replace(KV, st.read(KV))
    st.replace(KV, st.read(KV))
    assert rows(st.read(KV)) == [(1, "a", 1), (2, "b", 2)]


def test_bucketed_upsert_computes_its_batch_once_and_trusts_no_second_pass(spark, tmp_lake):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    st = TableStore(spark, tmp_lake, {KV.qualified: 8})
    st.replace(KV, spark.range(1_000).selectExpr("CAST(id AS INT) k", "'s' v", "0 w"))
    batch = spark.range(200).selectExpr("CAST(id AS INT) k", "'b' v", "1 w").mapInPandas(count, SCHEMA)
    st.upsert(KV, batch)
    assert seen.value == 200
    # a batch that gives other keys each time it is computed loses no stored row
    unstable = spark.range(300).selectExpr("CAST(rand() * 100000 AS INT) + 1000 k", "'u' v", "2 w").dropDuplicates(["k"])
    st.upsert(KV, unstable)
    assert st.read(KV).filter("k < 1000").count() == 1_000
    assert not st._names(f"{st.root}/_staged")


def test_a_bucket_gets_few_files(spark, tmp_lake):
    st = TableStore(spark, tmp_lake, {KV.qualified: 4}, files_per_bucket=2)
    st.replace(KV, spark.range(5_000, numPartitions=8).selectExpr("CAST(id AS INT) k", "'s' v", "0 w"))
    import glob
    files = glob.glob(st._current(KV).replace("file:", "") + "/_bucket=*/*.parquet")
    assert 4 <= len(files) <= 8


def test_null_keys_spread_over_the_buckets(spark, tmp_lake):
    st = TableStore(spark, tmp_lake, {KV.qualified: 4})
    st.upsert(KV, spark.range(400).selectExpr("CAST(NULL AS INT) k", "CAST(id AS STRING) v", "0 w"))
    st.upsert(KV, df(spark, [(1, "a", 1), (None, "n", 1)]))
    raw = st._read_raw(KV)
    assert raw.count() == 402 and raw.filter("k IS NULL").select("_bucket").distinct().count() == 4


def test_copy_into_another_bucket_count(spark, tmp_lake):
    a = TableStore(spark, tmp_lake + "/a", {KV.qualified: 2})
    b = TableStore(spark, tmp_lake + "/b", {KV.qualified: 5})
    a.replace(KV, df(spark, [(i, "x", i) for i in range(50)]))
    a.copy_to(KV, b)
    assert rows(a.read(KV)) == rows(b.read(KV))


def test_duplicate_check_sends_two_rows_of_a_key_at_most(spark):
    batch = spark.range(1_000).selectExpr("CAST(id % 7 AS INT) k", "'x' v", "CAST(id AS INT) w")
    with pytest.raises(Exception, match="two rows for one key"):
        keyed.one_per_key(batch, ["k"], keyed.ERROR).collect()
    plan = keyed.one_per_key(batch, ["k"], keyed.ERROR)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_keys_are_no_duplicates(spark):
    d = spark.createDataFrame([(1, None), (1, None), (1, None), (1, 2), (1, 2)], "a int, b int")
    assert check_constraints(d, ["a", "b"]).first().violations == 1
    assert check_constraints(d, ["a", "b"], null_keys=keyed.MATCH).first().violations == 3


def test_a_narrow_selection_still_checks_what_it_selects(spark):
    spec = S.TableSpec("t", "x", (S.Col("a", "int", not_null=True), S.Col("s", "string", 3)), key=("a",))
    bad = spark.createDataFrame([(None, "abcd")], "a string, s string")
    for c in ("a", "s"):
        with pytest.raises(Exception):
            conform_to(bad, spec).select(c).collect()


def test_store_refuses_other_bucket_count(spark, tmp_lake):
    spec = S.TableSpec("t", "nb", (S.Col("k", "int"), S.Col("v", "string"), S.Col("w", "int")), key=("k",))
    TableStore(spark, tmp_lake, {spec.qualified: 2}).replace(spec, df(spark, [(1, "a", 1)]))
    with pytest.raises(ValueError):
        TableStore(spark, tmp_lake, {spec.qualified: 4}).read(spec)


PAIR = S.TableSpec("conform", "pairs_of_text", (S.Col("k", "string"), S.Col("n", "int"), S.Col("doc", "string")), key=("k", "n"))


def _not_ranked(*_, **__):
    raise AssertionError("whole rows were ranked")


def test_first_load_shuffles_only_keys(spark, tmp_lake, monkeypatch):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "z"), (None, 1, "z")], PAIR.struct)
    monkeypatch.setattr(keyed, "one_per_key", _not_ranked)
    for buckets in ({}, {PAIR.qualified: 3}):
        for write in ("insert_ignore", "upsert"):
            st = TableStore(spark, f"{tmp_lake}/{write}-{len(buckets)}", buckets)
            getattr(st, write)(PAIR, batch)
            assert rows(st.read(PAIR)) == rows(batch)
            assert st._names(f"{st.root}/_staged") == []


def test_first_load_ranks_only_keys_on_several_rows(spark, tmp_lake):
    batch = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", 1, "z"), (None, 1, "v"), (None, 1, "u")], PAIR.struct)
    expected = rows(keyed.merge_insert_ignore(S.empty(spark, PAIR), batch, ["k", "n"], ["doc"]))
    for buckets in ({}, {PAIR.qualified: 3}):
        st = TableStore(spark, f"{tmp_lake}/{len(buckets)}", buckets)
        st.insert_ignore(PAIR, batch, order_by=["doc"])
        assert rows(st.read(PAIR)) == expected and len(expected) == 4
        other = TableStore(spark, f"{tmp_lake}/error-{len(buckets)}", buckets)
        with pytest.raises(ValueError, match="two rows for one key"):
            other.upsert(PAIR, batch)
        assert not other.exists(PAIR)
        other.upsert(PAIR, batch, on_duplicate=keyed.LAST, order_by=["doc"])
        assert [r for r in rows(other.read(PAIR)) if r[0] == "a"] == [("a", 1, "y")]
    st = TableStore(spark, f"{tmp_lake}/match")
    st.insert_ignore(PAIR, batch, order_by=["doc"], null_keys=keyed.MATCH)
    assert rows(st.read(PAIR)) == [("a", 1, "x"), ("b", 1, "z"), (None, 1, "u")]


def test_upsert_of_whole_rows_looks_up_only_keys(spark):
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), (None, 1, "v")], PAIR.struct)
    batch = spark.createDataFrame([("a", 1, None), ("c", 1, "w"), (None, 1, "u")], PAIR.struct)
    merged = keyed.merge_upsert(stored, batch, ["k", "n"])
    assert "FullOuter" not in merged._jdf.queryExecution().optimizedPlan().toString()
    assert rows(merged) == rows(spark.createDataFrame(
        [("a", 1, None), ("b", 1, "y"), ("c", 1, "w"), (None, 1, "v"), (None, 1, "u")], PAIR.struct))


def test_documents_stream_past_the_keys_they_are_fetched_for(spark):
    docs = spark.range(1000).selectExpr("CAST(id AS STRING) AS map_uid", "'{}' AS json_data")
    got = keyed_fetch(docs.select("map_uid"), TableTransport(docs, ("map_uid",), "json_data"), ["map_uid"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan and "SortMergeJoin" not in plan
    assert got.count() == 1000


def test_small_tasks_only_refine_settings_and_put_them_back(spark):
    scan, dealt, parts = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    before = [spark.conf.get(c) for c in (scan, dealt, parts)]
    spark.conf.set(dealt, "1m")
    with small_tasks(spark, 100 * PARTITION_BYTES):
        assert (spark.conf.get(scan), spark.conf.get(dealt), spark.conf.get(parts)) == (f"{SCAN_BYTES}b", f"{1 << 20}b", "100")
    spark.conf.unset(dealt)
    with small_tasks(spark):
        assert (spark.conf.get(dealt), spark.conf.get(parts)) == (f"{DEALT_BYTES}b", before[2])
    assert [spark.conf.get(c) for c in (scan, dealt, parts)] == before


def test_small_tasks_deal_several_tasks_a_core(spark):
    from strata.session import TASKS_PER_CORE
    least, grouped = "spark.sql.adaptive.coalescePartitions.minPartitionNum", "spark.sql.execution.replaceHashWithSortAgg"
    before = [spark.conf.get(c, None) for c in (least, grouped)]
    wanted = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    with small_tasks(spark):
        assert (spark.conf.get(least), spark.conf.get(grouped)) == (str(wanted), "true")
    spark.conf.set(least, str(wanted + 1))                  # no setting is made coarser
    with small_tasks(spark):
        assert spark.conf.get(least) == str(wanted + 1)
    spark.conf.unset(least)
    assert [spark.conf.get(c, None) for c in (least, grouped)] == before


def test_stored_keys_are_held_not_sorted(spark):
    stored = spark.createDataFrame([("a", 1, "x"), (None, 1, "v")], PAIR.struct)
    batch = spark.createDataFrame([("a", 1, "no"), ("c", 1, "second"), ("c", 1, "first"), (None, 1, "u"), (None, 1, "u")], PAIR.struct)
    new = keyed.new_rows(stored, batch, ["k", "n"], [batch.columns[-1]])
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(new) == rows(spark.createDataFrame([("c", 1, "first"), (None, 1, "u"), (None, 1, "u")], PAIR.struct))
