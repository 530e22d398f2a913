"""Operator 12 against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard as J
from strata.llm.common import prepare

from .helpers import bag, lower, no_documents, odd_documents, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


def plain_set(text, k=5):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=80, k=5):
    """Rows of one id are one document, linked by any of its texts."""
    sets = [(d, plain_set(t, k)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if a is not None and b is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return bag((d, len(s), None if d is None else find(d)) for d, s in sets)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        at = rng.randrange(len(w))
        w[at:at + 1] = rng.choice([[], [w[at], "new%d" % rng.randrange(99)], ["other%d" % rng.randrange(99)]])
    return w


def near_copies(seed, families=25, each=6):
    """Families of texts at all distances around the threshold, of 1 to 300 words."""
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = prose(rng, rng.choice([1, 3, 5, 6, 8, 9, 12, 20, 40, 80, 150, 300])).split()
        for _ in range(each):
            rows.append((len(rows), " ".join(edited(rng, base, rng.randint(0, 1 + len(base) // 25)))))
            if rng.random() < .3:
                base = rows[-1][1].split() or ["x"]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, percent", [(1, 80), (2, 80), (3, 60), (4, 95), (5, 100)])
def test_against_all_pairs(spark, seed, percent):
    rows = near_copies(seed)
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), percent=percent)
    assert bag(got.collect()) == brute(rows, percent)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_no_linked_pair_goes_unmet(percent):
    """Sets as far apart as the threshold allows, of all sizes: some key that the larger asks for is the smaller's."""
    rng = np.random.default_rng(percent)
    met = 0
    for _ in range(2000):
        n = int(rng.integers(1, 120))
        whole = rng.integers(0, 2**63, n).astype(np.uint64)
        a, b = (np.unique(np.concatenate((whole[rng.random(n) > rng.choice([0, .05, .1, .2])], rng.integers(0, 2**63, rng.integers(0, n // 8 + 1)).astype(np.uint64))))
                for _ in range(2))
        common = len(np.intersect1d(a, b))
        if not len(a) or not len(b) or 100 * common < percent * (len(a) + len(b) - common):
            continue
        small, large = sorted((a, b), key=len)
        key, kind, _ = J.entries(small, percent)
        listed, near = (set(key[kind & bit > 0].tolist()) for bit in (J.LISTED, J.NEAR))
        key, kind, unit = J.entries(large, percent)
        units = {(u, r): int(rng.integers(1, 9)) for u in unit.tolist() for r in (0, 1)}     # every key has company
        chosen = J.allotment(len(large), percent, units)
        hit = [(u, 0) in chosen and x in listed or (u, 1) in chosen and x in near if k & J.ASKS else (u, 1) in chosen and x in listed
               for x, k, u in zip(key.tolist(), kind.tolist(), unit.tolist())]
        assert any(hit)
        met += 1
    assert met > 100


def test_a_key_of_many_unrelated_sets(spark, monkeypatch):
    """Texts that share a passage but are no copies, with a family of copies among them; leaders come in rounds."""
    rng = random.Random(6)
    passage = prose(rng, 40)
    rows = [(i, passage + " " + prose(rng, 30)) for i in range(60)]
    rows += [(100 + i, rows[5][1] + f" end{i}") for i in range(30)]
    monkeypatch.setattr(J, "GROWTH", 2)
    monkeypatch.setattr(J, "DEAL", 3)
    monkeypatch.setattr(J, "COMPANY", 4)                # every hot key costs the same
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(got.collect()) == brute(rows)


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_parities_never_part_linked_sets(percent):
    """Sets as far apart as a link allows, of sizes on both sides of a change in the number of bins."""
    rng = np.random.default_rng(percent)
    parted = widths = 0
    for _ in range(1500):
        n = int(rng.choice([1, 3, 60, 130, 250, 260, 520, 1020, 1030, 5000]))
        whole = rng.integers(0, 2**63, n).astype(np.uint64)
        drop = rng.choice([0, .05, .1, .2, .5])
        a, b = (np.unique(np.concatenate((whole[rng.random(n) > drop], rng.integers(0, 2**63, rng.integers(0, n // 6 + 1)).astype(np.uint64)))) for _ in range(2))
        if not len(a) or not len(b):
            continue
        x, y = (int.from_bytes(J.parities(h), "little") for h in (a, b))
        common = len(np.intersect1d(a, b))
        far = J.too_far(len(a), x, len(b), y, percent)
        widths += J.bins(len(a)) != J.bins(len(b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            assert not far
        parted += far
    assert parted > 100 and widths > 10


def test_sets_that_share_a_key_only_are_no_pairs(spark, monkeypatch):
    """As many pairs are compared as there are copies, however many unrelated texts share a passage with them."""
    rng = random.Random(12)
    passage = prose(rng, 40)
    rows = [(i, passage + " " + prose(rng, 30)) for i in range(60)]
    rows += [(100 + i, rows[5][1] + f" end{i}") for i in range(30)]
    compared, verified = [], J.verified
    monkeypatch.setattr(J, "verified", lambda pairs, *a: compared.append(pairs.count()) or verified(pairs, *a))
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(got.collect()) == brute(rows)
    assert sum(compared) <= 2 * len(rows)


@pytest.mark.parametrize("clash", [False, True])
def test_odd_documents(spark, clash):
    got = J.near_duplicates(odd_documents(spark, clash))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert bag(got.collect()) == brute([r[:2] for r in odd_rows()])


def test_an_id_on_several_texts_is_one_document(spark):
    rng = random.Random(9)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (5, b), (3, b), (4, c), (4, None), (5, ""), (None, a)]
    got = J.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(got.collect()) == brute(rows)


def test_no_documents(spark):
    assert J.near_duplicates(no_documents(spark)).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert bag(J.near_duplicates(blank).collect()) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_keys_split_between_batches(spark):
    both, wide = J.LISTED | J.ASKS, J.NEAR | J.WIDE
    rows = [(k, both, 0, i, 9) for k in (1, 2, 3, 9) for i in range(k)] + [(4, J.LISTED, 0, 1, 9), (4, J.NEAR, 0, 2, 9), (5, J.ASKS, 0, 1, 9),
                                                                            (5, wide, 0, 2, 9), (6, wide, 0, 1, 9), (6, wide, 0, 2, 9)]
    df = spark.createDataFrame(rows, "key long, kind int, unit int, id long, size long").coalesce(1).sortWithinPartitions("key")
    schema = "key long, kind int, unit int, id long, size long, company int, wider int"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = bag(r[:1] + r[3:4] + r[5:] for r in map(tuple, df.mapInArrow(J._company(5), schema).collect()))
    finally:
        prepare(spark)
    want = [(k, i, k - 1, 0) for k in (2, 3) for i in range(k)] + [(5, 1, 0, 1), (5, 2, 0, 0)] + [(9, i, 4, 5) for i in range(9)]
    assert got == bag(want)
