"""The paged walk, the keyed fetch and the live feed builder, without a network."""
import io
import json
import pickle
import sys
import urllib.error

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from strata import schemas as S
from strata.plans import jobs
from strata.sinks.store import TableStore
from strata.sources import MemoryTransport, PageFiles, TableTransport, keyed_fetch, live_feeds, paged_feed, responses
from strata.sources.datasource import read_pages
from conftest import rows

# the stand-ins below go to Python workers, which don't have this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def page(y, m, days):
    return json.dumps({"year": y, "month": m, "days": days})


def walk(spark, lake, pages, n, first_round=4, **more):
    walk.runs = getattr(walk, "runs", 0) + 1
    got = paged_feed(spark, MemoryTransport(pages, "page_no"), n, land=f"{lake}/land{walk.runs}", first_round=first_round, **more)
    return [r.json_data for r in got.orderBy(F.col("data_year").desc(), F.col("data_month").desc(), F.col("data_day").desc()).collect()]


@pytest.mark.parametrize("first_round", [1, 2, 3, 4, 7])
def test_empty_pages_and_null_days_do_not_end_or_cut_the_walk(spark, tmp_lake, first_round):
    day = lambda m, d: json.dumps({"id": f"{m}-{d}"}, separators=(",", ":"))
    full = lambda m: [json.loads(day(m, d)) for d in range(1, 29)]
    pages = {0: page(2023, 6, []), 1: page(2023, 5, [None] * 27 + [json.loads(day(5, 28))]), 2: page(2023, 4, []), 3: page(2023, 3, full(3)),
             4: page(2023, 2, full(2)), 6: page(2022, 12, full(12))}
    want = [day(5, 28)] + [day(m, d) for m in (3, 2) for d in range(28, 0, -1)]
    assert walk(spark, tmp_lake, pages, 30, first_round) == want[:30]
    assert walk(spark, tmp_lake, pages, 500, first_round) == want          # page 5 is absent: the feed ends there
    assert walk(spark, tmp_lake, pages, None, first_round) == want


def test_the_walk_refuses_to_return_part_of_the_feed(spark, tmp_lake):
    pages = {i: page(2023 - i // 12, 12 - i % 12, [{"id": i}]) for i in range(40)}
    assert len(walk(spark, tmp_lake, pages, 10, max_pages=30)) == 10
    with pytest.raises(RuntimeError, match="30 pages"):
        walk(spark, tmp_lake, pages, 35, max_pages=30)
    for bad in ("<html>", '{"year": 2023, "month": 1}', "null", '{"year": 1, "month": 1, "days": "x"}'):
        with pytest.raises(Exception):
            walk(spark, tmp_lake, {**pages, 1: bad}, 5)


def test_pages_come_from_their_own_block_only(spark, tmp_lake):
    served = PageFiles(tmp_lake + "/served", block=4)
    df = spark.createDataFrame([(i, page(2023, 1, [{"id": i}])) for i in range(10)], "page_no bigint, json_data string")
    df.withColumn("block", F.floor(F.col("page_no") / 4)).write.partitionBy("block").parquet(served.path)
    assert served.fetch([{"page_no": "5"}, {"page_no": "10"}, {"page_no": "99"}]) == [page(2023, 1, [{"id": 5}]), None, None]


def test_a_transports_headers_show_in_no_plan(spark):
    secret = MemoryTransport({0: page(2023, 1, [])}, "page_no")
    secret.token = "do-not-show"
    df = read_pages(spark, secret, 0, 1)
    assert df.count() == 1 and "do-not-show" not in df._jdf.queryExecution().toString()


class Echo:
    """Answers with what it was asked and in which task."""

    def fetch(self, keys):
        from pyspark import TaskContext
        return [json.dumps({"key": k, "task": TaskContext.get().partitionId()}) for k in keys]


def test_keys_are_text_never_null_and_spread_over_tasks(spark):
    keys = spark.createDataFrame([(i, f"u{i}") for i in range(200)] + [(None, "x"), (7, None), (7, "u7")], "track_id int, uid string")
    got = keyed_fetch(keys.coalesce(1), Echo(), ["track_id"], partitions=6).collect()
    assert sorted(r.track_id for r in got) == list(range(200))
    assert all(json.loads(r.json_data)["key"] == {"track_id": str(r.track_id)} for r in got)
    assert len({json.loads(r.json_data)["task"] for r in got}) > 1
    assert keyed_fetch(keys, Echo(), ["track_id", "uid"]).count() == 200


def test_only_json_is_stored(spark):
    docs = MemoryTransport({1: '{"a": 1}', 2: None, 3: "[]"}, "k")
    keys = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    assert sorted(r.k for r in responses(keyed_fetch(keys, docs, ["k"])).collect()) == [1, 3]
    with pytest.raises(Exception, match="not JSON"):
        responses(keyed_fetch(keys, MemoryTransport({1: "<html>502</html>"}, "k"), ["k"])).collect()


class Site:
    """Stands in for the network: a path's answer, an error status, or nothing."""

    def __init__(self, answers):
        self.answers = answers

    def __call__(self, request, timeout):
        assert request.get_header("User-agent") == "strata-test"
        path = request.full_url.split("example.org", 1)[1]
        if isinstance(self.answers.get(path), int) or path not in self.answers:
            raise urllib.error.HTTPError(request.full_url, self.answers.get(path, 404), "no", {}, io.BytesIO(b"<html>"))
        return io.BytesIO(self.answers[path].encode())


def site_answers():
    def daily(uid, ex):
        return {"map": {"mapUid": uid, "exchangeid": ex, "authorplayer": {"name": "A", "id": "p"}, "authorScore": 1000, "timestamp": "2023-01-01"},
                "leaderboarduid": "lb"}
    out = {"/api/totd/0": page(2023, 2, []), "/api/totd/1": page(2023, 1, [daily("u1", 11), None, daily("u3", 0)])}
    for uid, track in (("u1", 11), ("u3", 33)):
        out[f"/api/maps/get_map_info/uid/{uid}"] = json.dumps({"TrackID": track, "GbxMapName": uid, "Tags": "3"})
        out[f"/api/maps/get_authors/{track}"] = json.dumps([{"Username": "A", "Role": ""}])
        tops = [{"player": {"name": f"w{i}", "id": str(i)}, "time": 500 + i, "timestamp": "2023-01-02"} for i in range(12)]
        out[f"/api/leaderboard/lb/{uid}?offset=0&length=10"] = json.dumps({"tops": tops})
    return out


def test_a_full_refresh_over_live_feeds(spark, tmp_lake):
    site = Site(site_answers())
    feeds = live_feeds(spark, "https://daily.example.org/", "https://maps.example.org", "strata-test", opener=site)
    assert pickle.loads(pickle.dumps(feeds.daily)).url == "https://daily.example.org/api/totd/{page_no}"
    st = TableStore(spark, tmp_lake + "/lake")
    jobs.Refresh(st, feeds, n=10).run()
    assert rows(st.read(S.CONSUME_TOTD), "exchange_id", "wr_username", "wr_replay_time") == [(11, "w0", 0.5)]
    # whatever was asked for, every entry of a stored document counts
    assert st.read(S.CONFORM_TMIO_LEADERBOARDS).groupBy("exchange_id").count().collect()[0]["count"] == 12
    assert rows(st.read(S.CONSUME_TOTD_TAGS)) == [(11, "Tech"), (33, "Tech")]
    assert st.read(S.REF_TMX_TAGS).count() == 47
    assert rows(st.read(S.COLLECT_TMX_AUTHORS), "track_id") == [(11,), (33,)]
    jobs.Refresh(st, feeds, n=10).run()
    assert st.read(S.COLLECT_TMX_AUTHORS).count() == 2 and st.read(S.CONSUME_TOTD).count() == 1


def test_an_error_page_is_never_stored_and_the_next_run_recovers(spark, tmp_lake):
    st, good = TableStore(spark, tmp_lake + "/lake"), site_answers()
    url = "/api/maps/get_map_info/uid/u3"
    for bad in ("<html>busy</html>", 502):
        feeds = live_feeds(spark, "https://d.example.org", "https://m.example.org", "strata-test", opener=Site({**good, url: bad}))
        r = jobs.Refresh(st, feeds, n=10)
        with pytest.raises(Exception):
            r.run("collect_map_info")
        assert st.read(S.COLLECT_TMX).count() == 0
    missing = live_feeds(spark, "https://d.example.org", "https://m.example.org", "strata-test",
                         opener=Site({k: v for k, v in good.items() if k != url}))
    jobs.Refresh(st, missing, n=10).run("collect_map_info")
    assert rows(st.read(S.COLLECT_TMX), "map_uid") == [("u1",)]
    healthy = live_feeds(spark, "https://d.example.org", "https://m.example.org", "strata-test", opener=Site(good))
    jobs.Refresh(st, healthy, n=10).run("conform_map_info")
    assert rows(st.read(S.CONFORM_TMX), "map_uid") == [("u1",), ("u3",)]


def test_quarantine_of_live_bodies(spark, tmp_lake):
    st = TableStore(spark, tmp_lake + "/lake")
    feeds = live_feeds(spark, "https://d.example.org", "https://m.example.org", "strata-test",
                       opener=Site({**site_answers(), "/api/maps/get_map_info/uid/u3": "<html>busy</html>"}))
    r = jobs.Refresh(st, feeds, n=10, on_violation="quarantine")
    r.run("collect_map_info")
    assert rows(st.read(S.COLLECT_TMX), "map_uid") == [("u1",)]
    assert [q.reason for q in r.quarantined(S.COLLECT_TMX).collect()] == ["bad json"]


def test_table_feed_asks_for_no_null_key(spark):
    t = spark.createDataFrame([(1, "{}"), (None, "{}")], "k int, d string")
    got = keyed_fetch(spark.createDataFrame([(1,), (None,), (2,)], "k int"), TableTransport(t, ("k",), "d"), ["k"])
    assert rows(got) == [(1, "{}"), (2, None)]
