"""The resumed walk: equal to the whole walk, and only new months are asked for."""
import json
import os
import sys
import tempfile
import uuid

import pytest
from pyspark import cloudpickle

from strata import schemas as S
from strata.plans import jobs
from strata.sinks.store import TableStore
from strata.sources import Feeds, MemoryTransport, paged_feed
from strata.sources.walk import WalkReader, month_of, resumed_feed

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Counted:
    """A feed of ``months`` (number -> days), the newest of which is page 0; each request leaves a mark on disk."""

    def __init__(self, months, log):
        self.months, self.log = months, log

    def page(self, number):
        m = max(self.months) - number
        return json.dumps({"year": m // 12, "month": m % 12 + 1, "days": self.months[m]}) if m in self.months else None

    def fetch(self, keys):
        for k in keys:
            open(os.path.join(self.log, f"{k['page_no']}-{uuid.uuid4().hex}"), "w").close()
        return [self.page(int(k["page_no"])) for k in keys]


JUNE = month_of('{"year": 2023, "month": 6}')


def feed(upto, days_of_newest=5, first=20):
    """Months from ``first`` before June 2023 to ``upto`` after it; one is empty, some days are null."""
    out = {m: [{"id": f"{m}-{d}"} if d % 4 else None for d in range(28)] for m in range(JUNE - first, JUNE + upto + 1)}
    out[JUNE - 3] = []
    out[max(out)] = out[max(out)][:days_of_newest]
    return out


def walk(spark, home, months, n, **more):
    """(entries, page numbers asked for)"""
    log = tempfile.mkdtemp(prefix="strata-walk-")
    served = Counted(months, log)
    got = [tuple(r) for r in resumed_feed(spark, served, n, home, **more).select("data_year", "data_month", "data_slot", "data_day", "json_data").collect()]
    asked = sorted(int(f.split("-")[0]) for f in os.listdir(log))
    pages = MemoryTransport({i: served.page(i) for i in range(len(months))}, "page_no")
    want = [tuple(r) for r in paged_feed(spark, pages, n, land=f"{home}/whole-{uuid.uuid4().hex}").select(
        "data_year", "data_month", "data_slot", "data_day", "json_data").collect()]
    assert sorted(got) == sorted(want)
    return got, asked


def test_a_second_run_asks_only_for_new_pages(spark, tmp_lake):
    got, asked = walk(spark, tmp_lake, feed(0), 40, first_round=4)
    assert len(got) == 40 and asked == [0, 0, 1, 2, 3]                    # page 0 twice: its month is asked for first
    assert walk(spark, tmp_lake, feed(0), 40)[1] == [0]                   # nothing new
    assert walk(spark, tmp_lake, feed(0, 9), 40)[1] == [0, 0]             # days more in the newest month
    assert walk(spark, tmp_lake, feed(2), 40)[1] == [0, 0, 1, 2]          # two months later: June may have grown
    assert walk(spark, tmp_lake, feed(2), 30)[1] == [0]
    got, asked = walk(spark, tmp_lake, feed(2), 200)                      # deeper: each month below those held, once
    deeper = [p for p in asked if p]
    assert len(got) == 200 and min(deeper) == 6 and len(deeper) == len(set(deeper))


def test_the_end_of_the_feed_is_found_once(spark, tmp_lake):
    got, asked = walk(spark, tmp_lake, feed(0, first=5), None, first_round=3)
    assert max(asked) >= 6 and len(got) == 4 * 21 + 3
    assert walk(spark, tmp_lake, feed(0, first=5), 500)[1] == [0]
    assert walk(spark, tmp_lake, feed(1, first=5), None)[1] == [0, 0, 1]


def test_an_empty_feed_and_one_that_goes_on(spark, tmp_lake):
    log = tempfile.mkdtemp(prefix="strata-walk-")
    assert resumed_feed(spark, MemoryTransport({}, "page_no"), 5, f"{tmp_lake}/none").count() == 0
    with pytest.raises(RuntimeError, match="goes on after 6 pages"):
        resumed_feed(spark, Counted(feed(0), log), 400, f"{tmp_lake}/long", max_pages=6)


def test_offsets_and_a_feed_that_turns_during_a_run():
    log = tempfile.mkdtemp(prefix="strata-walk-")
    reader = WalkReader({"depth": "3"}, Counted(feed(0), log))
    end = reader.latestOffset()
    assert (end["low"], end["high"]) == (JUNE - 2, JUNE)
    months = reader.partitions(reader.initialOffset(), end)
    assert [p.month for p in months] == [JUNE - 2, JUNE - 1, JUNE]
    assert reader.partitions(end, end) == []
    reader.transport = Counted(feed(1), log)
    with pytest.raises(RuntimeError, match="is of month"):
        list(reader.read(months[0]))


def test_a_refresh_can_resume_its_walk(spark, tmp_lake):
    for upto in (0, 1):
        log = tempfile.mkdtemp(prefix="strata-walk-")
        st = TableStore(spark, f"{tmp_lake}/lake")
        feeds = Feeds(Counted(feed(upto), log), None, None, None, S.seed_rows(spark))
        jobs.Refresh(st, feeds, n=30, walk=f"{tmp_lake}/walk").run("collect_daily")
    assert len(os.listdir(log)) == 3 and st.read(S.COLLECT_TMIO).count() == 30 + 21 - 3 + 3
