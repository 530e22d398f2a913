"""Requests that fail: asked again, at a bounded rate and a few at a time; no key is lost."""
import io
import json
import sys
import threading
import time
import urllib.error
from collections import Counter
from email.message import Message

import pytest
from pyspark import cloudpickle

from strata import schemas as S
from strata.plans import jobs
from strata.sinks.store import TableStore
from strata.sources import AskPolicy, HttpTransport, MemoryTransport, keyed_fetch, live_feeds
from strata.sources.asking import Asker, retry_after
from conftest import rows
from test_feeds import Site, site_answers

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["test_feeds"])

QUICK = AskPolicy(first_wait=0.001, longest_wait=0.01)


def status(url, code, **headers):
    h = Message()
    for k, v in headers.items():
        h[k.replace("_", "-")] = v
    return urllib.error.HTTPError(url, code, "no", h, io.BytesIO(b"<html>"))


class Troubled:
    """Gives each path's troubles in turn, then its answer."""

    def __init__(self, troubles):
        self.troubles, self.asked = troubles, Counter()

    def __call__(self, request, timeout):
        path = request.full_url.rsplit("/", 1)[1]
        tried = self.asked[path]
        self.asked[path] += 1
        trouble = (self.troubles.get(path, []) + [None] * 99)[tried]
        if isinstance(trouble, int):
            raise status(request.full_url, trouble, Retry_After="7") if trouble == 429 else status(request.full_url, trouble)
        if trouble is not None:
            raise trouble
        return io.BytesIO(json.dumps({"key": path}).encode())


TROUBLES = {"a": [429], "b": [500, 503], "c": [TimeoutError("slow"), urllib.error.URLError("reset")], "d": [404],
            "e": [403], "f": [500] * 50, "g": [ConnectionResetError("gone")] * 4}


def test_passing_errors_are_asked_again_and_lasting_ones_are_named():
    waits, site = [], Troubled(TROUBLES)
    got = HttpTransport("http://x/{k}", opener=site, policy=AskPolicy(window=3), sleep=waits.append).asker().ask([{"k": k} for k in "abcdefgh"])
    assert [a.text and json.loads(a.text)["key"] for a in got] == ["a", "b", "c", None, None, None, "g", "h"]
    assert [a.error for a in got] == [None, None, None, None, "status 403", "status 500 after 5 tries", None, None]
    assert site.asked == {"a": 2, "b": 3, "c": 3, "d": 1, "e": 1, "f": 5, "g": 5, "h": 1}
    assert 7.0 in waits and max(waits) <= 30 and len(waits) == 1 + 2 + 2 + 4 + 4


def test_fetch_raises_for_a_key_without_an_answer():
    t = HttpTransport("http://x/{k}", opener=Troubled(TROUBLES), policy=QUICK)
    assert t.fetch([{"k": "a"}, {"k": "d"}])[1] is None and t.fetch([]) == []
    with pytest.raises(RuntimeError, match="'e'.*status 403"):
        t.fetch([{"k": "a"}, {"k": "e"}])


def test_the_window_bounds_requests_under_way():
    lock, now, most = threading.Lock(), [0], [0]

    def request(key):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return str(key["k"])

    got = Asker(request, AskPolicy(window=4)).ask([{"k": i} for i in range(40)])
    assert [a.text for a in got] == [str(i) for i in range(40)] and 2 <= most[0] <= 4


@pytest.mark.parametrize("tasks", [1, 5])
def test_the_rate_is_shared_by_the_tasks(tasks):
    clock = [100.0]

    def sleep(s):
        clock[0] += s

    asker = Asker(lambda k: "", AskPolicy(window=1, per_second=10), tasks, clock=lambda: clock[0], sleep=sleep)
    for _ in range(3):                       # the pace holds over batches
        asker.ask([{"k": i} for i in range(7)])
    assert clock[0] - 100.0 == pytest.approx(20 * tasks / 10)


def test_retry_after_is_a_number_or_a_date():
    h = Message()
    assert retry_after(h, 0) == 0 and retry_after(None, 0) == 0
    for value, want in (("120", 120), ("Thu, 01 Jan 1970 00:01:00 GMT", 50), ("soon", 0)):
        h = Message()
        h["Retry-After"] = value
        assert retry_after(h, 10) == want


def test_policy_bounds():
    for bad in (dict(tries=0), dict(window=0), dict(per_second=0)):
        with pytest.raises(ValueError):
            AskPolicy(**bad)


def test_every_key_has_its_row_and_its_reason(spark):
    keys = spark.createDataFrame([(k,) for k in "abcdefgh"] + [(None,), ("a",)], "k string")
    t = HttpTransport("http://x/{k}", opener=Troubled(TROUBLES), policy=QUICK)
    got = {r.k: (r.json_data and json.loads(r.json_data)["key"], r.why) for r in keyed_fetch(keys, t, ["k"], partitions=3, error_col="why").collect()}
    assert got == {**{k: (k, None) for k in "abcgh"}, "d": (None, None), "e": (None, "status 403"), "f": (None, "status 500 after 5 tries")}
    with pytest.raises(Exception, match="no answer for"):
        keyed_fetch(keys, t, ["k"]).collect()
    assert keyed_fetch(keys.limit(0), t, ["k"], error_col="why").count() == 0
    kept = keyed_fetch(keys, MemoryTransport({"a": "{}"}, "k"), ["k"], error_col="why").collect()
    assert len(kept) == 8 and all(r.why is None for r in kept)


def test_a_refresh_lands_what_was_answered_and_lists_the_rest(spark, tmp_lake):
    st, good = TableStore(spark, tmp_lake + "/lake"), site_answers()
    info, board = "/api/maps/get_map_info/uid/u1", "/api/leaderboard/lb/u3?offset=0&length=10"

    def refresh(answers, **more):
        feeds = live_feeds(spark, "https://d.example.org", "https://m.example.org", "strata-test", opener=Site(answers), policy=QUICK)
        return jobs.Refresh(st, feeds, n=10, on_no_answer="set_aside", **more).run()

    r = refresh({**good, info: 503, board: "<html>busy</html>"})
    assert rows(st.read(S.COLLECT_TMX), "map_uid") == [("u3",)]
    assert rows(r.failed(S.COLLECT_TMX)) == [("u1", "status 503 after 5 tries")]
    assert rows(r.failed(S.COLLECT_TMIO_LEADERBOARDS)) == [("u3", "the response is not JSON: <html>busy</html>")]
    assert r.failed(S.COLLECT_TMX_AUTHORS).count() == 0
    assert st.read(S.CONSUME_TOTD).count() == 0
    r = refresh(good)
    assert rows(st.read(S.COLLECT_TMX), "map_uid") == [("u1",), ("u3",)]
    assert r.failed(S.COLLECT_TMX).count() == 0 and r.failed(S.COLLECT_TMIO_LEADERBOARDS).count() == 0
    assert rows(st.read(S.CONSUME_TOTD), "exchange_id", "wr_username") == [(11, "w0")]
    with pytest.raises(ValueError):
        jobs.Refresh(st, r.feeds, on_no_answer="drop").run("collect_map_info")
