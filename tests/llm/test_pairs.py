"""Operators that compare rows: exact search, decontamination, suffix-order and SimHash deduplication."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import components, decontam, lpf, simhash, vafile
from strata.llm.common import prepare
from strata.llm.queries import QUERIES

from .helpers import bag, lower, no_documents, odd_documents, odd_rows, prose, words

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


# ---- 2 exact top-k --------------------------------------------------------------------
def search(rows, asked, k):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: v for i, v in sorted(whole, reverse=True) if i in asked}.items()):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return bag(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")


@pytest.mark.parametrize("query_block", [2_048, 3])
def test_search_equals_all_pairs(spark, query_block):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, rows[i % 7][1]) for i in range(40)]                                    # ties
    rows += [(400, None), (401, [None] * 6), (402, [float("nan")] + [0.0] * 5), (403, [float("inf")] * 6), (None, [1.0] * 6),
             (404, [0.0] * 6), (450, [1.0, 2.0]), (451, [2.0, 1.0]), (500, []), (550, []), (600, [1e9] * 6), (601, [-1e9] * 6),
             (50, rows[3][1]), (7, rows[7][1])]                                              # repeated ids
    df = vectors(spark, rows)
    got = vafile.top_k(df.repartition(3), df.filter(F.col("vec_id") % 50 == 0), query_block=query_block).collect()
    assert bag(got) == search(rows, {i for i, _ in rows if i is not None and i % 50 == 0}, 5)


def test_search_of_few_or_no_vectors(spark):
    df = vectors(spark, [(0, [1.0]), (1, [2.0]), (2, [-1.0])])
    assert bag(vafile.top_k(df, df).collect()) == search([(0, [1.0]), (1, [2.0]), (2, [-1.0])], {0, 1, 2}, 5)
    assert vafile.top_k(df.limit(0), df.limit(0)).count() == 0
    assert vafile.top_k(df, df.limit(0)).count() == 0


def test_search_query_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = QUERIES["op2_top_k"](spark, SF001).collect()
    assert bag(got) == search(rows, {i for i, _ in rows if i % 50 == 0}, 5)


def test_bounds_leave_few_vectors_to_read(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(4_000, 64)) / 8)
    read = []
    monkeypatch.setattr(vafile, "exact", lambda v, q, f=vafile.exact: read.append(len(v)) or f(v, q))
    best = vafile.Best(20, 5)
    vafile.search_block(np.arange(4_000), x, np.arange(20), x[:20], best, np.arange(20))
    assert sum(read) < 0.2 * 20 * 4_000
    for q in range(20):
        s = x @ x[q]
        s[q] = -np.inf
        assert [i for _, i in best.rows[q]] == np.lexsort((np.arange(4_000), -s))[:5].tolist()


# ---- 3 decontamination -----------------------------------------------------------------
ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, "single"), (4, None), (5, ""),
         (None, "no name but long enough to be a window of ten words"), (1, "again the same id"), (20, "short ITEM"), (6, "a a a a a a a a a a a a"),
         (7, "aa"), (8, "café au lait"), (9, "one two three four five six seven eight nine ten")]
TEXTS = [(1, "x One, two; three four five six seven eight nine ten eleven zwölf"), (2, "a short item and a single one"), (3, "a " * 50),
         (4, None), (5, ""), (6, "no name but long enough to be a window of ten words"), (7, "CAFÉ au lait café au lait"), (8, "aa aaa aa"),
         (None, "short item"), (2, "a short item and a single one"), (9, "two three four five six seven eight nine ten eleven twelve"),
         (10, "again the same id again the same id"), (11, "nothing here")]


def windows(items):
    out = {}
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - 9) if w else 0):
            out.setdefault(tuple(w[at:at + 10]), set()).add("" if i is None else str(i))
    return out


def decontaminated(text, pats):
    w, hit, names = words(text), set(), set()
    for p, items in pats.items():
        for at in range(len(w) - len(p) + 1):
            if tuple(w[at:at + len(p)]) == p:
                hit.update(range(at, at + len(p)))
                names |= items
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("search_patterns", [50_000, 4])
def test_decontamination(spark, search_patterns):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, words int")
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in TEXTS], "doc_id long, text string, items int, hits int")
    rows = decontam.find(docs, items, search_patterns=search_patterns).select("doc_id", "found.n_words", decontam.n_hit(), "found.items").collect()
    pats = windows(ITEMS)
    assert bag((r[0], r[1], r[2], sorted(r[3])) for r in rows) == bag((d, *decontaminated(t, pats)) for d, t in TEXTS)


def test_decontamination_of_odd_and_no_documents(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.find(odd_documents(spark, True).drop("found"), items)
    assert got.count() == len(odd_rows()) and set(odd_documents(spark, True).columns) - {"found"} < set(got.columns)
    assert decontam.find(no_documents(spark), items).count() == 0
    assert {r.n for r in decontam.find(odd_documents(spark), items.limit(0)).select(F.size("found.hits").alias("n")).collect()} == {0}
    with pytest.raises(ValueError):
        decontam.find(odd_documents(spark, True), items)


def test_decontamination_query(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    pats = windows([(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()])
    by_first = {}
    for p, names in pats.items():
        by_first.setdefault(p[0], {})[p] = names
    want = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for at, x in enumerate(w):
            for p, items in by_first.get(x, {}).items():
                if tuple(w[at:at + len(p)]) == p:
                    hit.update(range(at, at + len(p)))
                    names |= items
        want.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    assert bag(QUERIES["op3_decontamination"](spark, SF01).collect()) == bag(want)


def test_skips_find_every_occurrence():
    rng = random.Random(4)
    for _ in range(300):
        alphabet = [b"a", b"b", b"c"][:rng.randint(1, 3)]
        n = rng.randint(1, 6)
        pats = {tuple(rng.choice(alphabet) for _ in range(n)): [str(i)] for i in range(rng.randint(1, 4))}
        text = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
        want = [(i, pats[tuple(text[i:i + n])]) for i in range(len(text) - n + 1) if tuple(text[i:i + n]) in pats]
        assert list(decontam.Search(n, pats)(text)) == want


# ---- 5 suffix-order deduplication ---------------------------------------------------------
def without_copies(rows, n=50):
    """(doc_id, bytes, removed, spans, hash of what is left) by looking every string up."""
    big = 1 << 62
    whole = [(big if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in whole:
        for i in range(len(t) - n + 1):
            first[t[i:i + n]] = min(first.get(t[i:i + n], big + 1), d)
    out = []
    for (d, _), (key, t) in zip(rows, whole):
        cut = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if first[t[i:i + n]] < key:
                cut[i:i + n] = True
        cut = cut[:len(t)]
        spans = int((np.diff(np.concatenate(([False], cut)).astype(int)) == 1).sum())
        out.append((d, len(t), int(cut.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~cut])).hexdigest()))
    return bag(out)


def lpf_digest(df, **options):
    rows = lpf.remove_copies(df, **options).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), "spans", "kept").collect()
    return bag((r[0], r[1], sum(s.end - s.start for s in r[2]), len(r[2]), hashlib.sha256(r[3]).hexdigest()) for r in rows)


@pytest.mark.parametrize("seed", range(5))
def test_copies_of_random_pieces(spark, seed):
    rng = random.Random(seed)
    letters = ["a", "ab", "abc", "é", "ab\n"][seed] + "x"
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(6)]
    rows = []
    for d in rng.sample(range(100), 30):
        kind = rng.random()
        rows.append((d, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) if kind < .6 else "a" * rng.randint(0, 3_000) if kind < .7
                     else "ab" * rng.randint(0, 900) if kind < .8 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 200))) + rng.choice(pieces)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = without_copies(rows)
    assert lpf_digest(df) == want
    assert lpf_digest(df, order_rows=1) == want                # blocks as small as the batches: the rest falls to Spark's sort


@pytest.mark.parametrize("n", [10, 2_000, 20_000])
def test_group_of_one_passage_with_other_surroundings(spark, n):
    """A passage of 70 bytes in every document, cut off by bytes of its own on both sides: one group of n different runs at either edge."""
    passage = "".join(random.Random(4).choice("abcdefghij") for _ in range(70))
    rows = [(d, f"{d * 7919 % 100_003:06d}{passage}{d % 7}{d * 104_729 % 1_000_003:07d}") for d in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert lpf_digest(df) == without_copies(rows)


def test_copies_in_odd_documents(spark):
    rows = [(d, t) for d, t, *_ in odd_rows() if d != 11]
    df = odd_documents(spark, True).filter("doc_id IS NULL OR doc_id <> 11").drop("spans", "kept")
    assert lpf_digest(df) == without_copies(rows)
    assert set(df.columns) < set(lpf.remove_copies(df).columns)
    assert lpf.remove_copies(no_documents(spark)).count() == 0


def test_copies_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert bag(QUERIES["op5_suffix_dedup"](spark, SF001).collect()) == without_copies(rows)


def test_pieces_of_long_texts_lose_no_run(monkeypatch):
    rng = random.Random(8)
    text = prose(rng, 400).encode()
    whole = {}
    for _ in range(2):
        starts = np.concatenate([s + np.arange(n) for _, _, b, p in lpf.runs_of(text) for s, n in zip(b, p)])
        assert sorted(starts.tolist()) == list(range(len(text) - 49))
        least = {s + i: h for hs, _, b, p in lpf.runs_of(text) for h, s, n in zip(hs, b, p) for i in range(n)}
        assert whole in ({}, least)
        whole = least
        monkeypatch.setattr(lpf, "PIECE", 100)


def test_previous_and_next_smaller():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50):
        d = rng.integers(0, 6, n)
        before, after = lpf.nearest_smaller(d)
        for i in range(n):
            assert before[i] == max((j for j in range(i) if d[j] < d[i]), default=-1)
            assert after[i] == min((j for j in range(i + 1, n) if d[j] < d[i]), default=-1)


# ---- 7 SimHash --------------------------------------------------------------------------
def plain_fingerprint(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", lower(text)) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(pairs, max_bits=3):
    fps = sorted({f for _, f in pairs})
    group = {f: f for f in fps}
    for _ in fps:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= max_bits and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
        if not changed:
            break
    least = {}
    for d, f in pairs:
        if d is not None:
            least[group[f]] = min(least.get(group[f], d), d)
    return {f: least.get(g) for f, g in group.items()}


def test_fingerprints_and_groups_of_odd_documents(spark):
    got = simhash.near_duplicates(odd_documents(spark, True)).select("doc_id", "fingerprint", "component_id").collect()
    pairs = [(d, plain_fingerprint(t)) for d, t, *_ in odd_rows()]
    group = plain_components([p for p in pairs if p[0] is not None])
    assert bag(got) == bag((d, f"{f:016x}", None if d is None else group[f]) for d, f in pairs)
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize("key_rows", [50_000, 20])
def test_links_equal_all_pairs(spark, monkeypatch, key_rows):
    """Clouds of fingerprints around a few centres, chains, and far ones."""
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for c in fps[:6]:
        f = c
        for _ in range(60):
            fps.append(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))                 # a chain
            fps.append(f)
    fps += [0, 1, 7, 15, 2**64 - 1, 2**63, 2**63 + 2**62]
    pairs = [(i, f) for i, f in enumerate(rng.sample(fps, len(fps)))]
    table = spark.createDataFrame([(i, 0, f - 2**64 if f >> 63 else f) for i, f in pairs], "doc_id long, text_hash long, fp long").repartition(4)
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: table)
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    got = simhash.near_duplicates(no_documents(spark), key_rows=key_rows).select("doc_id", "component_id").collect()
    group = plain_components(pairs)
    assert bag(got) == bag((i, group[f]) for i, f in pairs)


def test_a_key_of_many_classes_gives_few_links(spark):
    """2,000 fingerprints within one ball of a segment: links grow with them, not with their pairs."""
    rng = random.Random(9)
    fps = {0xABCDEF << 32 | sum(1 << b for b in rng.sample(range(11), rng.randint(0, 11))) for _ in range(20_000)}
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert len(fps) > 1_500 and simhash.links(classes).count() < 40 * len(fps)


def test_one_of_each_group_stays(spark):
    docs = odd_documents(spark)
    stays = simhash.one_of_each(docs).select("doc_id").collect()
    group = plain_components([(d, plain_fingerprint(t)) for d, t, *_ in odd_rows() if d is not None])
    nulls = [d for d, *_ in odd_rows() if d is None]
    assert bag(stays) == bag((d,) for d in [*set(group.values()), *nulls])
    assert simhash.one_of_each(docs).columns == docs.columns


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 300)] + [(1_000, 1_000 + i) for i in range(1, 50)] + [(2_000, 2_001), (2_001, 2_002), (2_002, 2_000), (5, 5), (None, 3)]
    links = [(b, a) if rng.random() < .5 else (a, b) for a, b in links]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 if i <= 300 else 1_000 if i < 2_000 else 2_000 for i in [*range(301), *range(1_000, 1_050), 2_000, 2_001, 2_002]}
