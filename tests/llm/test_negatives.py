"""Operator 13 against all products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import negatives as N
from strata.llm.common import prepare

from .helpers import bag

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


def brute(rows, anchor_every=N.ANCHOR_EVERY, k=5, m=3):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    anchors = {}
    for i, v, label in kept:
        if i % anchor_every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        score = sorted((-sum(x * y for x, y in zip(v, w)), i, own) for i, w, own in kept if i != a and len(w) == len(v))
        for s, p, _ in [x for x in score if x[2] == label][:k]:
            near = [(i, t) for t, i, own in score if own != label and -50 * s <= -100 * t <= -95 * s][:m]
            out += [(a, p, r + 1, i, -s, -t) for r, (i, t) in enumerate(near)]
    return bag(out)


def vectors(seed, n=400, dim=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    own = rng.integers(0, labels, n)
    v = centres[own] * .5 + rng.normal(size=(n, dim)) * .2 + .2
    return [(i, v[i].tolist(), int(own[i])) for i in range(n)]


def mined(spark, rows, anchor_every=N.ANCHOR_EVERY, **more):
    df = N.relabelled(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return N.mine(df, df.filter(F.col("vec_id") % anchor_every == 0), **more)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_products(spark, seed):
    rows = vectors(seed)
    assert bag(mined(spark, rows, 10, block_rows=16, anchor_block=9).collect()) == brute(rows, 10)


def odd():
    rows = vectors(3, 120, 4)
    rows += [(200, [1.0, 2.0], 1), (250, [1.0, 2.0], 1), (201, [1.0, 1.5], 2), (300, [], 1), (301, [], 1), (302, [], 2),
             (350, None, 1), (351, [1.0] * 4, None), (352, [1.0, None, 1.0, 1.0], 1), (353, [float("nan")] * 4, 1), (354, [float("inf")] * 4, 1),
             (None, [1.0] * 4, 1), (400, [0.0] * 4, 1), (401, [0.0] * 4, 1), (402, [0.0] * 4, 3), (450, [-1.0] * 4, 1), (451, [1e6] * 4, 2),
             (500, [3e4] * 4, -3), (501, [2.9e4] * 4, -3), (502, [2e4] * 4, 9)]
    tie = [(600 + i, [.5, .5, .5, .5], i % 2) for i in range(60)]
    return rows + rows[:5] + tie + [(50, [.1, .2, .3, .4], 0)]


def test_odd_vectors(spark):
    rows = odd()
    assert bag(mined(spark, rows, block_rows=8).collect()) == brute(rows)


def test_extra_columns_and_empty_tables(spark):
    rows = odd()
    random.Random(1).shuffle(rows)
    df = N.relabelled(spark.createDataFrame(rows, SCHEMA))
    for c in ("v", "dim", "curve", "block", "anchor_id", "score", "rank", "positives"):
        df = df.withColumn(c, F.lit("x"))
    got = N.mine(df, df.filter("vec_id % 50 = 0"), block_rows=32)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert bag(got.collect()) == brute(rows)
    assert N.mine(df.limit(0), df.limit(0)).collect() == []
    assert N.mine(df, df.limit(0)).collect() == []


def test_no_block_that_is_needed_goes_unread():
    rng = np.random.default_rng(5)
    zone = rng.integers(-200, 200, (64, 8)).astype(float)
    anchors = N.Anchors([{"vec_id": i, "label": 0, "v": v} for i, v in enumerate(rng.integers(-200, 200, (20, 8)).astype(float))], 8)
    least, most = anchors.bounds(zone.min(axis=0), zone.max(axis=0))
    scores = anchors.vectors @ zone.T
    assert (least[:, None] <= scores).all() and (scores <= most[:, None]).all()


def test_zone_maps_leave_blocks_unread(spark):
    """In few dimensions, blocks along the curve are tight, and most are not asked by most anchors."""
    df = spark.createDataFrame(vectors(7, 2_000, 3), SCHEMA).selectExpr("vec_id", "CAST(label AS long) AS label", "transform(embedding, x -> floor(256 * x) * 1.0D) AS v")
    blocks = N.index(df, 32)
    rows = df.filter("vec_id % 20 = 0").collect()
    zones = blocks.coalesce(1).select("block", "dim", "n", "label_low", "label_high", "low", "high")
    all_rows = df.collect()

    def asked(choose, floors=None):
        anchors = N.Anchors([{**r.asDict(), "floor": floors and floors[r.vec_id]} for r in rows], 3)
        shared = type("Shared", (), {"value": {3: anchors}})()
        return zones.mapInArrow(choose(shared), "block string, asked binary").selectExpr("octet_length(asked) / 4 AS n").agg(F.sum("n")).first()[0]

    assert asked(N._likeliest) == len(rows)
    floors = {r.vec_id: sorted(np.dot(r.v, x.v) for x in all_rows if x.label == r.label and x.vec_id != r.vec_id)[-5] for r in rows}
    some = asked(lambda shared: N._zones(shared, N._for_positives), floors)
    assert len(rows) <= some < len(rows) * blocks.count() / 8


def test_hilbert_places_are_neighbours():
    """Every cell once, and each next to the one before."""
    for dim, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), axis=-1).reshape(-1, dim)
        keys = N.hilbert_key(cells, bits)
        order = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()
