"""Jobs on hand-written payloads (the cases listed for the feed fixtures)."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata import schemas as S
from strata.plans import jobs
from strata.sinks import keyed
from strata.sinks.constraints import conform_to
from strata.sinks.store import TableStore
from strata.sources.transports import MemoryTransport, TableTransport
from strata.sources.feeds import paged_feed
from conftest import rows


def payload(uid, ex, name="A", pid="p1", ts="2023-01-01T10:00:00Z", **extra):
    m = {"mapUid": uid, "authorplayer": {"name": name, "id": pid}, "authorScore": 45123,
         "goldScore": 48000, "silverScore": 54000, "bronzeScore": 68000,
         "submitterplayer": {"name": name, "id": pid}, "timestamp": ts}
    if ex is not None:
        m["exchangeid"] = ex
    m.update(extra)
    return {"map": m, "leaderboarduid": "lb-" + uid}


def raw_daily(spark, items):
    data = [(y, m, d, 1, json.dumps(p) if not isinstance(p, str) else p) for (y, m, d), p in items]
    return spark.createDataFrame(data, S.COLLECT_TMIO.struct)


def test_conform_daily_sentinel_absent_and_units(spark):
    raw = raw_daily(spark, [((2023, 1, 2), payload("u1", 0)), ((2023, 1, 3), payload("u2", None)),
                            ((2023, 1, 4), payload("u3", 77, ts="2023-01-01T23:30:00+05:00"))])
    out = conform_to(jobs.conform_tmio_batch(raw), S.CONFORM_TMIO)
    got = {r.map_uid: r for r in out.collect()}
    assert got["u1"].exchange_id is None and got["u2"].exchange_id is None and got["u3"].exchange_id == 77
    assert got["u3"].author_time == 45.123 and got["u3"].uploaded_day == 1
    assert got["u1"].leaderboard_uid == "lb-u1" and got["u1"].author_id == "p1"


def test_conform_daily_null_map_fails_and_json_null_payload(spark):
    raw = raw_daily(spark, [((2023, 1, 2), {"leaderboarduid": "x"})])
    with pytest.raises(Exception):
        conform_to(jobs.conform_tmio_batch(raw), S.CONFORM_TMIO).collect()
    raw = raw_daily(spark, [((2023, 1, 2), "null")])
    with pytest.raises(Exception):   # a row of NULLs: its NULL map uid breaks the primary key
        conform_to(jobs.conform_tmio_batch(raw), S.CONFORM_TMIO).collect()
    with pytest.raises(Exception):
        jobs.conform_tmio_batch(raw_daily(spark, [((2023, 1, 2), "{oops")])).collect()


def test_same_map_on_two_days_first_stays(spark, tmp_lake):
    st = TableStore(spark, tmp_lake)
    raw = raw_daily(spark, [((2023, 1, 5), payload("u1", 5)), ((2023, 1, 2), payload("u1", 5, name="B"))])
    st.insert_ignore(S.CONFORM_TMIO, conform_to(jobs.conform_tmio_batch(raw), S.CONFORM_TMIO),
                     order_by=["totd_year", "totd_month", "totd_day", "author_id"])
    r = st.read(S.CONFORM_TMIO).collect()
    assert len(r) == 1 and r[0].totd_day == 2 and r[0].author_name == "B"


def test_conform_map_info_tags_and_laps(spark):
    docs = [("m1", {"TrackID": 1, "GbxMapName": "$fffRed", "Tags": "3, 9", "Laps": 3, "UploadedAt": "2022-12-30T10:00:00"}),
            ("m2", {"TrackID": "2", "Tags": "", "UpdatedAt": "2023-01-01"}),
            ("m3", {"TrackID": 3, "Tags": "7,7,99", "Laps": 1}),
            ("m4", {"TrackID": 4})]
    raw = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs], S.COLLECT_TMX.struct)
    got = {r.map_uid: r for r in conform_to(jobs.conform_tmx_batch(raw), S.CONFORM_TMX).collect()}
    assert got["m1"].map_tags == [3, 9] and got["m1"].laps == 3 and got["m1"].uploaded_day == 30
    assert got["m2"].map_tags == [] and got["m2"].track_id == 2 and got["m2"].updated_year == 2023
    assert got["m3"].map_tags == [7, 7, 99] and got["m4"].map_tags is None and got["m4"].laps is None
    tags = S.seed_rows(spark)
    bridge = keyed.merge_insert_ignore(S.empty(spark, S.CONSUME_TOTD_TAGS),
                                       conform_to(jobs.totd_tags_batch(spark.createDataFrame(list(got.values()), S.CONFORM_TMX.struct), tags),
                                                  S.CONSUME_TOTD_TAGS), ["exchange_id", "tag_name"], ["exchange_id"])
    assert rows(bridge) == [(1, "Offroad"), (1, "Tech"), (3, "SpeedTech")]


def test_authors_role_blank_to_null_and_reset(spark, tmp_lake):
    st = TableStore(spark, tmp_lake)
    def land(doc):
        raw = spark.createDataFrame([(10, json.dumps(doc))], S.COLLECT_TMX_AUTHORS.struct)
        st.upsert(S.CONFORM_TMX_AUTHORS, conform_to(jobs.conform_authors_batch(raw), S.CONFORM_TMX_AUTHORS),
                  update_cols=["author_role"])
    land([{"Username": "a", "Role": "Builder"}, {"Username": "b", "Role": ""}, {"Username": "c", "Role": None}])
    assert rows(st.read(S.CONFORM_TMX_AUTHORS)) == [(10, "a", "Builder"), (10, "b", None), (10, "c", None)]
    land([{"Username": "a", "Role": ""}])
    assert rows(st.read(S.CONFORM_TMX_AUTHORS)) == [(10, "a", None), (10, "b", None), (10, "c", None)]


def _fact_inputs(spark):
    tmio = spark.createDataFrame([
        (2023, 1, 2, "u1", 11, "A", "p1", 45.0, 48.0, 54.0, 68.0, "A", "p1", 2022, 12, 30, "lb1"),
        (2023, 1, 3, "u2", None, "B", "p2", 40.0, None, None, None, "B", "p2", 2023, 1, 1, "lb2"),
        (2023, 1, 4, "u3", 33, "C", "p3", 50.0, None, None, None, "C", "p3", 2023, 1, 2, "lb3"),
        (2023, 1, 5, "u4", 34, "D", "p4", 50.0, None, None, None, "D", "p4", 2023, 1, 2, "lb4"),
    ], S.CONFORM_TMIO.struct)
    tmx = spark.createDataFrame([
        ("u1", 11, "$fffName$iWor", None, None, [1], 2, 2022, 12, 30, None, None, None),
        ("u2", 22, "Two", None, None, [], 1, 2022, 12, 31, None, None, None),
        ("u3", 34, "Three", None, None, [], None, 2023, 1, 1, None, None, None),
        ("u4", 44, "Four", None, None, [], None, 2023, 1, 1, None, None, None),
    ], S.CONFORM_TMX.struct)
    lead = spark.createDataFrame([
        (11, "x", "9", 30.5, 2023, 1, 3), (11, "y", "1", 30.5, 2023, 1, 3), (11, "z", "2", 31.0, 2023, 1, 1),
        (22, "w", "5", 20.0, 2023, 1, 4),
        (33, "s", "3", 12.0, 2023, 1, 5), (34, "t", "4", 11.0, 2023, 1, 6),
    ], S.CONFORM_TMIO_LEADERBOARDS.struct)
    return tmx, tmio, lead


def test_daily_fact_semantics(spark):
    tmx, tmio, lead = _fact_inputs(spark)
    fact = {r.exchange_id: r for r in conform_to(jobs.totd_batch(tmx, tmio, lead), S.CONSUME_TOTD).collect()}
    # u2 has no exchange id: its track's record never counts, so it drops out
    assert set(fact) == {11, 33, 34}
    r = fact[11]
    assert r.totd_date == dt.date(2023, 1, 2) and r.totd_day_of_week == "MONDAY   "
    assert r.map_name == "Namer" and r.is_multilap_flag is True and r.days_before_totd == 3
    assert (r.wr_username, r.wr_user_id, r.wr_replay_time) == ("y", "1", 30.5)   # tie: date, then player id
    # ids disagree (33 vs track 34) and both hold a record: one row, the least time wins
    assert fact[33].wr_username == "t" and fact[33].wr_replay_time == 11.0
    ties = jobs.totd_batch(tmx, tmio, lead, tie=jobs.TIE_ALL)
    assert len([x for x in ties.collect() if x.exchange_id == 11]) == 2
    with pytest.raises(Exception):
        jobs.totd_batch(tmx, tmio, lead, tie=jobs.TIE_ERROR).collect()


def test_daily_fact_join_form_equals_window_form(spark):
    tmx, tmio, lead = _fact_inputs(spark)
    a = rows(jobs.totd_batch(tmx, tmio, lead, method="window"))
    b = rows(jobs.totd_batch(tmx, tmio, lead, method="join"))
    assert a == b


def test_author_bridge_only_uploader_gets_id(spark):
    authors = spark.createDataFrame([(11, "A", None), (11, "Z", "Builder"), (99, "A", None)], S.CONFORM_TMX_AUTHORS.struct)
    tmx, tmio, _ = _fact_inputs(spark)
    out = rows(jobs.totd_authors_batch(authors, tmio))
    assert out == [(11, "A", "p1", None), (11, "Z", None, "Builder"), (99, "A", None, None)]


def test_paged_feed_walks_pages_until_n(spark, tmp_lake):
    def page(y, m, n):
        return json.dumps({"year": y, "month": m, "days": [payload("u%d-%d-%d" % (y, m, d), d) for d in range(1, n + 1)]})
    pages = {0: page(2023, 2, 3), 1: page(2023, 1, 31), 2: page(2022, 12, 31), 3: json.dumps({"year": 2022, "month": 11, "days": []})}
    tr = MemoryTransport(pages, "page_no")
    got = paged_feed(spark, tr, 5, land=tmp_lake + "/land", first_round=1)
    r = rows(got, "data_year", "data_month", "data_day")
    assert r == [(2023, 1, 29), (2023, 1, 30), (2023, 1, 31), (2023, 2, 1), (2023, 2, 2), (2023, 2, 3)][1:]
    table = spark.createDataFrame(list(pages.items()), "page_no bigint, json_data string")
    same = paged_feed(spark, TableTransport(table, ("page_no",), "json_data"), 5)
    assert rows(same, "data_year", "data_month", "data_day") == r
    everything = paged_feed(spark, tr, None, land=tmp_lake + "/land2", first_round=1)
    assert len(everything.collect()) == 65


def test_quarantine_mode_routes_bad_rows(spark, tmp_lake):
    st = TableStore(spark, tmp_lake)
    st.replace(S.COLLECT_TMIO, raw_daily(spark, [
        ((2023, 1, 2), payload("good", 5)),
        ((2023, 1, 3), "{not json"),
        ((2023, 1, 4), payload("badcast", "abc")),
        ((2023, 1, 5), payload("x" * 60, 6)),
        ((2023, 1, 6), {"leaderboarduid": "no map"}),
    ]))
    r = jobs.Refresh(st, feeds=None, n=None, on_violation="quarantine")
    r.conform_daily()
    assert [x.map_uid for x in st.read(S.CONFORM_TMIO).collect()] == ["good"]
    want = ["bad exchange_id", "bad json", "map_uid longer than 50", "null map_uid"]
    assert sorted(x.reason for x in r.quarantined(S.CONFORM_TMIO).collect()) == want
    r.conform_daily()                                     # a second run sets the same rows aside, once
    assert sorted(x.reason for x in r.quarantined(S.CONFORM_TMIO).collect()) == want


def test_wrong_shapes_fail_or_are_set_aside(spark, tmp_lake):
    docs = [("a", '{"tops": [{"player": {"name": "x", "id": "1"}, "time": 5}]}'), ("b", '{"tops": "oops"}'), ("c", '{"tops": null}')]
    tmio = spark.createDataFrame([(2023, 1, d, u, d, "A", "p", 1.0, 1.0, 1.0, 1.0, "A", "p", 2023, 1, 1, "lb")
                                  for d, (u, _) in enumerate(docs, 1)], S.CONFORM_TMIO.struct)
    for mode, authors in (("fail", '{"error": "not found"}'), ("quarantine", '{"error": "not found"}')):
        st = TableStore(spark, f"{tmp_lake}/{mode}")
        st.replace(S.CONFORM_TMIO, tmio)
        st.replace(S.CONFORM_TMX, S.empty(spark, S.CONFORM_TMX))
        st.replace(S.COLLECT_TMIO_LEADERBOARDS, spark.createDataFrame(docs, S.COLLECT_TMIO_LEADERBOARDS.struct))
        st.replace(S.COLLECT_TMX_AUTHORS, spark.createDataFrame([(10, authors), (11, '[{"Username": "u", "Role": "r"}]')], S.COLLECT_TMX_AUTHORS.struct))
        r = jobs.Refresh(st, feeds=None, n=None, on_violation=mode)
        if mode == "fail":
            for step in (r.conform_leaderboards, r.conform_authors):
                with pytest.raises(Exception):
                    step()
        else:
            r.conform_leaderboards()
            r.conform_authors()
            assert rows(st.read(S.CONFORM_TMX_AUTHORS)) == [(11, "u", "r")]
            assert rows(st.read(S.CONFORM_TMIO_LEADERBOARDS), "exchange_id", "player_id") == [(1, "1")]
            assert [x.reason for x in r.quarantined(S.CONFORM_TMIO_LEADERBOARDS).collect()] == ["wrong shape"]
            assert [x.reason for x in r.quarantined(S.CONFORM_TMX_AUTHORS).collect()] == ["wrong shape"]


def test_two_maps_on_one_key_fail_or_go_by_uid(spark, tmp_lake):
    tmx, tmio, lead = _fact_inputs(spark)
    twin = tmio.filter("map_uid = 'u1'").replace({"u1": "z1"}, subset=["map_uid"])
    tmio = tmio.unionByName(twin)
    tmx = tmx.unionByName(tmx.filter("map_uid = 'u1'").replace({"u1": "z1"}, subset=["map_uid"]).replace({"$fffName$iWor": "Twin"}, subset=["map_name"]))
    st = TableStore(spark, tmp_lake)
    with pytest.raises(Exception, match="two rows for one key"):
        st.upsert(S.CONSUME_TOTD, conform_to(jobs.totd_batch(tmx, tmio, lead), S.CONSUME_TOTD))
    fact = {r.exchange_id: r for r in jobs.totd_batch(tmx, tmio, lead, on_collision=jobs.COLLIDE_FIRST).collect()}
    assert set(fact) == {11, 33, 34} and fact[11].map_name == "Namer"
    undated = tmio.withColumn("totd_year", F.lit(None).cast("int"))
    assert len([r for r in jobs.totd_batch(tmx, undated, lead, on_collision=jobs.COLLIDE_FIRST).collect() if r.exchange_id == 11]) == 2


def test_seeding_the_reference_layer_twice_gives_the_catalogue(spark, tmp_lake):
    st = TableStore(spark, tmp_lake)
    feeds = type("Feeds", (), {"tags": S.seed_rows(spark)})()
    for _ in range(2):
        jobs.Refresh(st, feeds).seed_reference()
    assert st.read(S.REF_TMX_TAGS).count() == 47
    st.replace(S.CONFORM_TMX, spark.createDataFrame([("u", 5, "n", None, None, [3, 99], 1, 2023, 1, 1, None, None, None)], S.CONFORM_TMX.struct))
    jobs.Refresh(st, None).totd_tags()                    # reads the stored catalogue
    assert rows(st.read(S.CONSUME_TOTD_TAGS)) == [(5, "Tech")]


def test_record_key_coalesced_counts_every_key(spark):
    tmx, tmio, lead = _fact_inputs(spark)
    as_written = {r.exchange_id for r in jobs.records(tmio, lead).collect()}
    coalesced = {r.exchange_id for r in jobs.records(tmio, lead, record_key=jobs.RECORD_COALESCED).collect()}
    assert as_written == {11, 33, 34} and coalesced == {11, 22, 33, 34}
    fact = {r.exchange_id for r in jobs.totd_batch(tmx, tmio, lead, record_key=jobs.RECORD_COALESCED).collect()}
    assert 22 in fact          # the map without an exchange id keeps its record when asked to


def test_live_keyed_fetch_is_landed_before_the_sink(spark, tmp_lake):
    st = TableStore(spark, tmp_lake + "/lake")
    tmio = spark.createDataFrame([
        (2023, 1, d, "u%d" % d, d, "A", "p", 1.0, 1.0, 1.0, 1.0, "A", "p", 2023, 1, 1, "lb%d" % d) for d in range(1, 6)
    ], S.CONFORM_TMIO.struct)
    st.replace(S.CONFORM_TMIO, tmio)
    docs = {"u%d" % d: json.dumps({"TrackID": d, "Tags": "1"}) for d in range(1, 6)}
    feeds = type("Feeds", (), {"map_info": MemoryTransport(docs, "map_uid")})()
    r = jobs.Refresh(st, feeds, n=3, land=tmp_lake + "/landing")
    r.collect_map_info()
    got = rows(st.read(S.COLLECT_TMX), "map_uid")
    assert got == [("u3",), ("u4",), ("u5",)]          # the latest three days
    landed = spark.read.parquet(tmp_lake + "/landing/map_info-*")
    assert sorted(x.map_uid for x in landed.collect()) == ["u3", "u4", "u5"]
