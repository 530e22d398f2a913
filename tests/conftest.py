import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", app="strata-tests", shuffle_partitions=8, driver_memory="6g")
    # tests run locally: the shared folder is a fresh temporary one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(spark):
    from strata.session import scratch_path
    return scratch_path(spark, "test")


def _sort_key(t):
    return tuple((v is None, v if v is not None else 0) if not isinstance(v, str) else (v is None, v) for v in t)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_sort_key)
