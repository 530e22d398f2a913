"""Jobs take in only what changed: nothing on an unchanged re-run, and the same answer as a full recompute."""

import random

import pytest
from pyspark.sql import functions as F

from strata import schemas as S
from strata.plans import jobs
from strata.schemas import Col, TableSpec
from strata.sinks.changes import changed, pending
from strata.sinks.store import DIGEST, TableStore, keyed_buckets, upsert_buckets

SOURCE = TableSpec("collect", "docs", (Col("a", "int"), Col("b", "int"), Col("json_data", "string")), key=("a", "b"))
TARGET = TableSpec("conform", "docs", (Col("a", "int"),), key=("a",))


def store_of(spark, root, buckets=0):
    return TableStore(spark, root, {SOURCE.qualified: buckets} if buckets else None, digested=(SOURCE.qualified,))


def docs(spark, rows):
    return spark.createDataFrame(rows, SOURCE.struct)


@pytest.mark.parametrize("buckets", [0, 4])
def test_changed_rows_once(spark, tmp_lake, buckets):
    st = store_of(spark, tmp_lake, buckets)
    st.upsert(SOURCE, docs(spark, [(1, 1, "x"), (2, 1, ""), (3, 1, None)]))
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))

    def take():
        with changed(st, "job", SOURCE, TARGET) as found:
            return sorted((r.a, r.json_data or "") for r in found.rows().collect())

    assert take() == [(1, "x"), (2, ""), (3, "")]
    assert take() == []
    st.upsert(SOURCE, docs(spark, [(1, 1, "x"), (2, 1, None), (4, 1, "new")]))
    assert take() == [(2, ""), (4, "new")]                    # NULL and '' differ
    assert take() == []
    st.upsert(SOURCE, docs(spark, [(1, 1, "y")]))
    assert take() == [(1, "y")]
    st.upsert(SOURCE, docs(spark, [(1, 1, "x")]))             # back to what was taken in before
    assert take() == [(1, "x")]


def test_a_failed_job_finds_its_rows_again(spark, tmp_lake):
    st = store_of(spark, tmp_lake)
    st.upsert(SOURCE, docs(spark, [(1, 1, "x")]))
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))
    with pytest.raises(RuntimeError):
        with changed(st, "job", SOURCE, TARGET) as found:
            assert found.any
            st.upsert(SOURCE, docs(spark, [(1, 1, "later")]))  # what was looked at is what is marked
            raise RuntimeError("killed")
    assert pending(st, "job", SOURCE, TARGET).count() == 1
    with changed(st, "job", SOURCE, TARGET) as found:
        st.upsert(SOURCE, docs(spark, [(1, 1, "latest")]))
    assert pending(st, "job", SOURCE, TARGET).count() == 1
    assert not st._names(f"{st.root}/_changed")


def test_null_keys_and_a_lost_target(spark, tmp_lake):
    st = store_of(spark, tmp_lake)
    st.upsert(SOURCE, docs(spark, [(None, 1, "x"), (1, None, "y"), (1, 1, "z")]))
    for left in (3, 3):                                        # the target was never written: all rows count as changed
        assert pending(st, "job", SOURCE, TARGET).count() == left
        with changed(st, "job", SOURCE, TARGET) as found:
            assert found.rows().count() == 3
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))
    assert pending(st, "job", SOURCE, TARGET).count() == 0


def test_digests_are_read_without_the_documents(spark, tmp_lake):
    st = store_of(spark, tmp_lake)
    st.upsert(SOURCE, docs(spark, [(1, 1, "x")]))
    plan = st.digests(SOURCE)._jdf.queryExecution().executedPlan().toString()
    assert DIGEST in plan and "json_data" not in plan
    assert st.read(SOURCE).columns == SOURCE.names


# ---- record holders ----------------------------------------------------------------
def tables(rng, n=30):
    """Maps with either or both ids, and days that share ids with other maps' track ids."""
    tmio, tmx = [], []
    for i in range(n):
        ex = rng.choice([None, i, i, (i + 1) % n])
        tmio.append((2023, 1 + i // 28, 1 + i % 28, f"u{i}", ex, "A", "p", 60.0, None, None, None, "A", "p", 2022, 12, 31, f"lb{i}"))
        tmx.append((f"u{i}", i, f"Map {i}", None, None, [1], 1, 2022, 12, 30, None, None, None))
    return tmio, tmx


def entries(rng, n=30):
    return {(i, p): (float(rng.randint(10, 14)), 2023, 2, 1 + rng.randint(0, 5)) for i in range(n) for p in "abc" if rng.random() < .7}


@pytest.mark.parametrize("seed", [1, 2])
def test_records_of_touched_maps_equal_a_full_recompute(spark, tmp_lake, seed):
    """Times that rise, fall, tie and stay; new entries, new days and new maps."""
    rng = random.Random(seed)
    tmio, tmx = tables(rng)
    lead = entries(rng)
    stores = {}
    for name, only in (("part", True), ("full", False)):
        st = TableStore(spark, f"{tmp_lake}/{name}", upsert_buckets(4))
        stores[name] = st, jobs.Refresh(st, None, n=None, changed_only=only)
    for round_ in range(3):
        days, maps = (tmio[:20], tmx[:18]) if round_ == 0 else (tmio, tmx)
        if round_:
            for key in rng.sample(sorted(lead), 12):
                time, *date = lead[key]
                lead[key] = (time + rng.choice([-3.0, 0.0, 2.0, 5.0]), *date)
            lead.update({(i, "d"): (11.0, 2023, 3, 1) for i in rng.sample(range(30), 3)})
        for st, r in stores.values():
            st.insert_ignore(S.CONFORM_TMIO, spark.createDataFrame(days, S.CONFORM_TMIO.struct), order_by=["map_uid"])
            st.insert_ignore(S.CONFORM_TMX, spark.createDataFrame(maps, S.CONFORM_TMX.struct), order_by=["map_uid"])
            rows = [(i, p.upper(), p, *v) for (i, p), v in lead.items()]
            st.upsert(S.CONFORM_TMIO_LEADERBOARDS, spark.createDataFrame(rows, S.CONFORM_TMIO_LEADERBOARDS.struct),
                      update_cols=jobs.UPDATE_LEADERBOARD)
            r.totd()
        part, full = (sorted(map(tuple, st.read(S.CONSUME_TOTD).collect()), key=repr) for st, _ in stores.values())
        assert part == full and part


def test_a_collision_with_an_untouched_map_is_still_refused(spark, tmp_lake):
    st = TableStore(spark, tmp_lake)
    r = jobs.Refresh(st, None, n=None)

    def day(uid, ex):
        return (2023, 1, 1, uid, ex, "A", "p", 60.0, None, None, None, "A", "p", 2022, 12, 31, "lb")

    def info(uid, track):
        return (uid, track, uid, None, None, [], 1, 2022, 12, 30, None, None, None)

    st.insert_ignore(S.CONFORM_TMIO, spark.createDataFrame([day("u1", 5)], S.CONFORM_TMIO.struct), order_by=["map_uid"])
    st.insert_ignore(S.CONFORM_TMX, spark.createDataFrame([info("u1", 50)], S.CONFORM_TMX.struct), order_by=["map_uid"])
    st.upsert(S.CONFORM_TMIO_LEADERBOARDS, spark.createDataFrame([(5, "X", "x", 9.0, 2023, 1, 1)], S.CONFORM_TMIO_LEADERBOARDS.struct))
    r.totd()
    st.insert_ignore(S.CONFORM_TMIO, spark.createDataFrame([day("u2", 5)], S.CONFORM_TMIO.struct), order_by=["map_uid"])
    st.insert_ignore(S.CONFORM_TMX, spark.createDataFrame([info("u2", 51)], S.CONFORM_TMX.struct), order_by=["map_uid"])
    with pytest.raises(Exception, match="two rows for one key"):
        r.totd()


def test_a_second_refresh_parses_nothing_and_rewrites_no_bucket(spark, tmp_lake, monkeypatch):
    from strata.plans import encode
    st = TableStore(spark, f"{tmp_lake}/lake", keyed_buckets(4))
    feeds = encode.encoded_feeds(spark, "/root/testdata/sf0.001", f"{tmp_lake}/feeds")
    jobs.Refresh(st, feeds, n=None).run(parallel=False)
    specs = (S.CONFORM_TMIO, S.CONFORM_TMX, S.CONFORM_TMX_AUTHORS, S.CONFORM_TMIO_LEADERBOARDS, S.CONSUME_TOTD,
             S.CONSUME_TOTD_TAGS, S.CONSUME_TOTD_AUTHORS, S.COLLECT_TMX_AUTHORS, S.COLLECT_TMIO_LEADERBOARDS)
    files = lambda: {s.qualified: sorted(f for f in st._read_raw(s).inputFiles()) for s in specs}
    before, parsed = files(), []
    for name in ("conform_tmio_batch", "conform_tmx_batch", "conform_authors_batch", "conform_leaderboards_batch", "totd_batch", "totd_tags_batch"):
        monkeypatch.setattr(jobs, name, lambda *a, name=name, **k: parsed.append(name))
    jobs.Refresh(st, feeds, n=None).run(parallel=False)
    assert parsed == [] and files() == before


# ---- a first run reads and writes nothing twice -------------------------------------
@pytest.mark.parametrize("buckets", [0, 4])
def test_a_first_run_looks_no_key_up(spark, tmp_lake, buckets):
    st = store_of(spark, tmp_lake, buckets)
    st.upsert(SOURCE, docs(spark, [(1, 1, "x"), (None, 1, "n"), (None, 1, "m")]))
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))
    with changed(st, "job", SOURCE, TARGET) as found:
        assert "Join" not in found.rows()._jdf.queryExecution().optimizedPlan().toString()
        assert found.rows().count() == 3 and not st._names(f"{tmp_lake}/progress/job")     # marked in the end
    st.upsert(SOURCE, docs(spark, [(1, 1, "y")]))
    with changed(st, "job", SOURCE, TARGET) as found:          # one of the rows on (NULL, 1) was remembered
        assert "Join" in found.rows()._jdf.queryExecution().optimizedPlan().toString()
        assert found.keys.filter("a = 1").count() == 1 and found.keys.count() == 2


def test_a_failed_first_run_marks_nothing(spark, tmp_lake):
    st = store_of(spark, tmp_lake, 4)
    st.upsert(SOURCE, docs(spark, [(1, 1, "x")]))
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))
    with pytest.raises(RuntimeError):
        with changed(st, "job", SOURCE, TARGET):
            raise RuntimeError("killed")
    assert pending(st, "job", SOURCE, TARGET).count() == 1 and not st._names(f"{st.root}/_changed")


def test_a_first_load_is_shuffled_once_and_coded(spark, tmp_lake, monkeypatch):
    from strata.sinks import store as module
    st = store_of(spark, tmp_lake, 4)
    dealt = []
    real = module.TableStore._write
    monkeypatch.setattr(module.TableStore, "_write", lambda self, *a, as_dealt=False, **k: (dealt.append(as_dealt), real(self, *a, as_dealt=as_dealt, **k))[1])
    st.upsert(SOURCE, docs(spark, [(i, 1, "x") for i in range(50)]))
    st.upsert(SOURCE, docs(spark, [(i, 1, "y") for i in range(60)]))
    assert dealt == [True, False] and st.read(SOURCE).filter("json_data = 'y'").count() == 60
    assert all(".zstd." in f for f in st._read_raw(SOURCE).inputFiles())


def test_a_feed_is_encoded_when_a_job_asks_for_it(spark, tmp_lake):
    from strata.plans import encode
    st = TableStore(spark, tmp_lake)
    feeds = encode.encoded_feeds(spark, "/root/testdata/sf0.001", f"{tmp_lake}/feeds")
    assert st._names(f"{tmp_lake}/feeds") == []
    assert feeds.map_info.responses.count() > 0 and feeds.map_info.responses.count() > 0
    assert st._names(f"{tmp_lake}/feeds") == ["map_info"]


def test_listed_entries_meet_their_order_once(spark):
    """Repeated customers, orders without entries or customer, entries without an order."""
    import datetime
    from strata.plans import encode
    day = datetime.datetime(2020, 1, 2)
    rows = spark.createDataFrame([(1, 1, "S", 7, 2.0, day, "R"), (1, 2, "T", 8, 3.0, day, "N"), (9, 1, "S", 7, 1.0, day, "A")],
                                 "l_orderkey long, entry int, s_name string, l_suppkey long, l_quantity double, l_shipdate timestamp, l_returnflag string")
    orders = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(5, "C"), (5, "C")], "c_custkey long, c_name string")
    lists = encode.order_lists(rows, orders, customer)
    board = encode.leaderboards(lists).collect()
    assert [(r.map_uid, r.leaderboard_uid) for r in board] == [("m1", "lb5")]
    assert board[0].json_data.startswith('{"tops":[{"player":{"name":"S","id":7},"time":2000.0,"timestamp":"2020-01-02T00:00:00+00:00"}')
    own = '{"Username":"C","Role":""}'
    assert {r.track_id: r.json_data for r in encode.authors(lists).collect()} == {
        1: f'[{own},{own},{{"Username":"S","Role":"R"}},{{"Username":"T","Role":"N"}}]', 2: f"[{own},{own}]", 9: '[{"Username":"S","Role":"A"}]'}


def test_shuffles_are_removed_while_a_refresh_runs(spark, tmp_lake, monkeypatch):
    from strata.session import CLEANUP
    before, seen = spark.conf.get(CLEANUP), []
    monkeypatch.setattr(jobs.Refresh, "seed_reference", lambda self: seen.append(spark.conf.get(CLEANUP)))
    jobs.Refresh(TableStore(spark, tmp_lake), None).run("seed_reference")
    assert seen == ["true"] and spark.conf.get(CLEANUP) == before


def test_digests_tell_where_a_null_and_an_element_stands(spark, tmp_lake):
    spec = TableSpec("conform", "wide", (Col("k", "int"), Col("a", "string"), Col("b", "string"), Col("l", "array<int>")), key=("k",))
    st = TableStore(spark, tmp_lake, digested=(spec.qualified,))
    rows = [("x", None, None), (None, "x", None), ("x", "", None), ("", "x", None), ("xx", "", None), (None, None, []), (None, None, None),
            (None, None, [None]), (None, None, [1]), (None, None, [1, None]), (None, None, [None, 1])]
    st.upsert(spec, spark.createDataFrame([(i, *r) for i, r in enumerate([*rows, rows[0]])], spec.struct))
    found = dict(st.digests(spec).collect())
    assert len(set(found.values())) == len(rows) and found[0] == found[len(rows)]
    assert all(0 < len(d) <= 16 for d in found.values())


def test_responses_are_not_stored_beside_the_layers(spark, tmp_lake):
    """What a refresh stores of a feed are its collect tables; only rows that feeds share are landed."""
    from strata.plans import encode
    st = TableStore(spark, f"{tmp_lake}/lake")
    jobs.Refresh(st, encode.encoded_feeds(spark, "/root/testdata/sf0.001", f"{tmp_lake}/feeds"), n=None).run("totd", parallel=False)
    assert sorted(st._names(f"{tmp_lake}/feeds")) == ["_listed", "map_info"]
    landed = spark.read.parquet(f"{tmp_lake}/feeds/_listed").columns + spark.read.parquet(f"{tmp_lake}/feeds/map_info").columns
    assert "json_data" not in landed and st.read(S.CONSUME_TOTD).count() > 0


def test_map_info_is_dealt_before_it_is_encoded(spark):
    from strata.plans import encode
    from strata.sources.feeds import keyed_fetch, responses
    from strata.sources.transports import TableTransport
    orders = encode.read_table(spark, "/root/testdata/sf0.001", "orders")
    made = TableTransport(encode.map_info(orders), ("map_uid",), "json_data")
    got = responses(keyed_fetch(made.responses.select("map_uid"), made, ["map_uid"]))
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    encoded = [i for i, line in enumerate(plan) if "StructsToJson" in line]
    dealt = [i for i, line in enumerate(plan) if "RepartitionByExpression [map_uid" in line]
    assert len(encoded) == 1 and any(i > encoded[0] for i in dealt)
    assert got.count() == orders.count()


def test_lines_are_dealt_once_to_be_listed(spark):
    from strata.plans import encode
    t = lambda n: encode.read_table(spark, "/root/testdata/sf0.001", n)
    rows = encode.leaderboard_rows(t("lineitem"), t("supplier"))
    plan = rows.groupBy("l_orderkey").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(l_orderkey" in plan


def test_pages_are_dealt_before_they_are_encoded(spark):
    """However few row groups the orders have, the pages are encoded by as many tasks as they are dealt to."""
    from strata.plans import encode
    orders, customer = (encode.read_table(spark, "/root/testdata/sf0.001", n) for n in ("orders", "customer"))
    pages = encode.daily_pages(orders, customer)
    plan = pages._jdf.queryExecution().optimizedPlan().toString().split("\n")
    encoded = [i for i, line in enumerate(plan) if "to_json" in line or "StructsToJson" in line]
    dealt = [i for i, line in enumerate(plan) if "RepartitionByExpression [o_orderkey" in line]
    assert len(encoded) == 1 and len(dealt) == 1 and dealt[0] > encoded[0]
    assert pages.count() == orders.join(customer, orders.o_custkey == customer.c_custkey).count()


@pytest.mark.parametrize("rows", [0, 1, 300])
def test_what_was_taken_in_is_held_not_sorted(spark, tmp_lake, rows):
    st = store_of(spark, tmp_lake)
    st.upsert(SOURCE, docs(spark, [(i, 1, "x") for i in range(300)] + [(None, 1, "n")]))
    st.replace(TARGET, spark.createDataFrame([(1,)], TARGET.struct))
    with changed(st, "job", SOURCE, TARGET):
        pass
    st.upsert(SOURCE, docs(spark, [(i, 1, "y") for i in range(rows)] + [(1000, 1, "new")]))
    left = pending(st, "job", SOURCE, TARGET)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.a for r in left.collect()) == [*range(rows), 1000]


def test_the_second_refresh_runs_each_step_once(spark, monkeypatch):
    from strata.plans import checks
    ran = []
    for step in jobs.Refresh.ORDER:
        real = getattr(jobs.Refresh, step)
        monkeypatch.setattr(jobs.Refresh, step, lambda self, real=real, step=step: (ran.append(step), real(self))[1])
    monkeypatch.setattr(checks, "_CHANGED", {})
    store, taken = checks._refreshed_in_part(spark, "/root/testdata/sf0.001")
    assert sorted(ran) == sorted(2 * jobs.Refresh.ORDER)
    # taken in: the documents of every seventh order in whose later feed a time is another (every third order, every second player)
    keys = [int(r.map_uid[1:]) for r in taken.collect()]
    assert keys and all(k % 21 == 0 for k in keys) and len(keys) == len(set(keys))
