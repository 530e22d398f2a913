"""Operators on single texts: quality, licenses, token counts, language ID, main text, packing."""

import collections
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import bpe, html_text, langid, licenses, packing, quality
from strata.llm.common import prepare

from .helpers import VOCABULARY, bag, lower, no_documents, odd_documents, odd_rows, words

PATH = public_tokenizers.path(VOCABULARY)
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


# ---- 6 token counts, 10 packing ---------------------------------------------------
def test_pre_tokens_and_merges_equal_the_library(library):
    rng = random.Random(3)
    pool = [chr(i) for i in range(0x250)] + [*"̀٠   Ⅷ　中﻿​\U0001f600\U0010ffff"]
    texts = ["".join(rng.choice(pool) if rng.random() < .5 else rng.choice(" \n\ta'st1.") for _ in range(rng.randint(0, 25))) for _ in range(3_000)]
    texts += ["a" * 5_000, "ab" * 3_000 + " \n\n x", "it's we'll I'M", "a<|endoftext|>b <|endoftext|><|endoftext|>", ""]
    spec = open(PATH, "rb").read()
    counter, encoder = bpe.MergeCounter(spec, cache_size=500), packing.Encoder(spec, cache_size=500)
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert counter.count(t) == len(e.ids), t
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == e.ids, t


@pytest.mark.parametrize("clash", [False, True])
def test_token_counts(spark, library, clash):
    got = bpe.token_counts(odd_documents(spark, clash), PATH).collect()
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in odd_rows()]
    assert bag(got) == bag([(d, b, n, n > 512) for d, b, n in want])
    assert bpe.token_counts(no_documents(spark), PATH).count() == 0


def test_texts_encoded_together_are_encoded_alike(library, monkeypatch):
    texts = ["", "one two  three", "<|endoftext|> \n x", "ab " * 400, "\u4e2d \u00e9 's", "one", "two three", "x" * 300, " \n \n"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    with open(PATH, "rb") as f:
        spec = f.read()
    for chars, size in ((1, 500), (700, 500), (10**6, 500), (10**6, 3)):
        monkeypatch.setattr(packing, "LEARN_CHARS", chars)
        got = list(packing.Encoder(spec, cache_size=size).encode_all(texts))
        assert [list(memoryview(x).cast("I")) for x in got] == expected


def test_new_words_of_several_texts_are_encoded_in_one_call(monkeypatch):
    with open(PATH, "rb") as f:
        encoder = packing.Encoder(f.read())
    words = []
    encoder.ids.make = words.append
    list(encoder.encode_all(["one two", "two three", "three one"]))
    assert not words


def check_packing(rows, docs, library, window=2048):
    want = collections.Counter()
    for d, t, *_ in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        for at in range(0, len(ids), window):
            piece = np.array(ids[at:at + window], "<u4").tobytes()
            want[d, at, len(piece) // 4, zlib.crc32(piece), len(ids)] += 1
    assert want == collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
    return sequences


@pytest.mark.parametrize("group_pieces", [20_000, 4])
def test_packing_loses_and_overlaps_nothing(spark, library, group_pieces):
    rows = packing.pack(odd_documents(spark, True), PATH, group_pieces=group_pieces).collect()
    check_packing(rows, odd_rows(), library)
    assert packing.pack(no_documents(spark), PATH).count() == 0


def test_packing_leaves_little_open(spark, library):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    sequences = check_packing(rows, docs.select("doc_id", "text").collect(), library)
    filled = sum(r.length for r in rows)
    assert filled > 0.98 * 2048 * len(sequences)


def test_tightest_open_window_is_taken():
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    free, want = [], []
    for n in lengths:                                     # best fit by looking at every open window
        fit = [(c, -i) for i, c in enumerate(free) if c >= n]
        if fit:
            i = -min(fit)[1]
        else:
            i = len(free)
            free.append(64)
        want.append(free[i])
        free[i] -= n
    packer, opened = packing.Packer(64), {}
    for n, before in zip(lengths, want):
        w, at = packer.place(n)
        assert 64 - at == before and at == opened.get(w, 0)
        opened[w] = at + n


# ---- 8 language ID ------------------------------------------------------------------
def test_language_of_odd_documents(spark):
    rows = langid.identify(odd_documents(spark, True)).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (4, 5, 6, 7))
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows} <= {"en", "fr", "de", "und"}
    assert by_id[16].lang_pred == "de" and by_id[17].lang_pred == "fr"
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_language_without_anything_to_learn_from(spark):
    assert langid.identify(no_documents(spark)).count() == 0
    blank = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(blank).collect()} == {("und", 0.0)}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = langid.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 200 and np.mean([r.lang == r.lang_pred for r in got]) > 0.98


def test_language_is_learnt_from_the_learning_rows_only(spark):
    docs = odd_documents(spark)
    changed = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit("xx")).otherwise(F.col("lang")))
    assert bag(langid.identify(docs).collect()) == bag(langid.identify(changed).collect())


def test_grams_in_chunks_give_the_same_sums(monkeypatch):
    model = langid.Model(["a", "b"], np.random.default_rng(1).normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.log([.5, .5]))
    texts = ["hello world", None, "12", "some longer text " * 50, ""]
    want = model.score(texts)
    monkeypatch.setattr(langid, "CHUNK", 7)
    got = model.score(texts)
    assert got[0] == want[0] and np.allclose(got[1], want[1])


# ---- 1 quality ----------------------------------------------------------------------
def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality.classify(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert len(got) > 50 and np.mean([r.predicted == r.quality for r in got]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_quality_of_odd_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (2, 0, 0), (3, None, None), (None, 1, 1), (7, 0, 0), (11, 1, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.classify(odd_documents(spark, True), labels).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    none = quality.classify(odd_documents(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    one = quality.classify(odd_documents(spark), labels.filter("quality = 1")).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5
    assert quality.classify(no_documents(spark), labels).count() == 0


def test_quality_ignores_labels_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert bag(quality.classify(docs, labels).collect()) == bag(quality.classify(docs, turned).collect())


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(5)
    x = rng.random((2_000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) != (x[:, 5] > 0.5)).astype(float)
    model = quality.fit(x, y, rounds=40)
    assert {model.pairs[0][0], model.pairs[0][1]} == {2, 5}
    assert np.mean((model.score(x) > 0.5) == (y == 1)) > 0.9


# ---- 4 licenses ---------------------------------------------------------------------
PHRASES = {tuple(p.split()): k for p, k in licenses.PHRASES}


def base_of(doc_id, text):
    w = words(text)
    at = [(i, k) for i in range(len(w)) for p, k in PHRASES.items() if tuple(w[i:i + len(p)]) == p]
    starts = [i for i, _ in at]
    return doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for _, k in at}))


def test_license_phrases(spark):
    docs = odd_rows() + [(50, "general public general public license license mit", "en", "a", 1),
                         (51, "mit license " * 3_000, "en", "a", 1), (52, "MİT LİCENSE mit-license Mit\nLicense", "en", "a", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
    rows = licenses.scan(df.withColumn("label", F.lit("x"))).collect()
    assert bag(tuple(r)[:6] for r in rows) == bag(base_of(d, t) for d, t, *_ in docs)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in rows)
    assert licenses.scan(no_documents(spark)).count() == 0


def test_license_texts_with_words_put_in_and_left_out(spark):
    text = licenses.TEXTS[3][0].split()
    edited = text[:8] + ["extra", "words"] + text[8:20] + text[22:]
    half = text[:len(text) // 3]
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(
        [(1, "intro " + " ".join(edited) + " end"), (2, " ".join(half)), (3, " ".join(sorted(text)))], "doc_id long, text string")).collect()}
    assert rows[1].labels == "bsd" and rows[1].n_base == 0 and 0.7 <= rows[1].score < 1
    assert rows[2].labels == "" and rows[3].labels == ""
    spans = licenses.spans(spark.createDataFrame([(1, "intro " + " ".join(edited))], "doc_id long, text string")).filter("template > 0").collect()
    assert [(s.first_word, s.last_word) for s in spans] == [(1, len(edited))]


def longest_run(text, template):
    """The most word pairs of ``template`` that stand in ``text`` in order, by the plain table of all pairs of places."""
    a, b = list(zip(text, text[1:])), list(zip(template, template[1:]))
    best = [0] * (len(b) + 1)
    for x in a:
        best = [0] + [max(best[j + 1], old) if x != y else best[j] + 1 for j, (y, old) in enumerate(zip(b, best[1:]))]
        for j in range(1, len(best)):
            best[j] = max(best[j], best[j - 1])
    return max(best) / len(b)


def test_license_spans_hold_distinct_places_in_order(spark):
    mpl, mit, bsd, isc, apache = (next(t for t, k in licenses.TEXTS if k == name).split() for name in ("mpl", "mit", "bsd", "isc", "apache"))
    docs = [
        ("this source code form " * 4, ""), ("this source code form " * 500, ""), ("public license v 2 0 " * 9, ""),
        ("this source code form " * 50 + " ".join(mpl), "mpl"), (" ".join(mpl + mpl), "mpl"), (" ".join(mpl[5:] + mpl[:5]), ""),
        (" ".join(mit[:20] + bsd[:10] + mit[20:]), ""), (" ".join(mit[:20] + ["x"] * 5 + mit[20:40] + ["y"] * 5 + mit[40:]), "mit"),
        (" ".join(mit[20:40] + mit[:20] + mit[40:]), ""), (" ".join(mit).upper(), "mit"), (" ".join(mit[:40]), ""),
        (" ".join(isc).replace("copy", "\u0130copy"), "isc"), (" ".join(apache).replace("kind", "\u212Aind"), "apache"),
        (" ".join(mit) + " z" * 40 + " " + " ".join(bsd), "bsd,mit"),
    ] + [(t, k) for t, k in licenses.TEXTS]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(docs)], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, (text, want) in enumerate(docs):
        base = set(rows[i].base_labels.split(","))
        assert set(filter(None, rows[i].labels.split(","))) - base == set(filter(None, want.split(","))) - base, text[:60]
        if rows[i].labels and not rows[i].base_labels:
            assert rows[i].score == pytest.approx(max(longest_run(words(text), t.split()) for t, _ in licenses.TEXTS)), text[:60]
    found = licenses.spans(df.filter("doc_id IN (3, 7)")).filter("template > 0 AND NOT phrase").collect()
    assert {(s.doc_id, s.first_word, s.last_word) for s in found} == {(3, 200, 200 + len(mpl) - 1), (7, 0, len(mit) + 9)}
    assert len(licenses.spans(df.filter("doc_id = 4")).filter("template > 0 AND NOT phrase").collect()) == 2


# ---- 9 main text --------------------------------------------------------------------
PAGES = [
    ("<article><h1>Title</h1><p>One.<p>Two <b>bold</b><br>line</article>", "Title\nOne.\nTwo bold line"),
    ("<body><nav><a href=x>Home</a></nav><div class='ad'>Buy now</div><main><p>a &lt;b&gt; &#233;&nbsp;x</p>"
     "<aside>see also</aside><section class='comments'><p>first!</p></section></main><footer>(c)</footer>", "a <b> é x"),
    ("<article><p>x</p><script>if(a<b){'</p>'}</script><style>p{}</style><!-- <p>no</p> --><form><label>Name</label></form></article>", "x"),
    ("<header><h1>Site</h1></header><article><header><h1>Story</h1></header><p>Text</p><div id=cookie-notice>OK?</div></article>", "Story\nText"),
    ("<p>" + "plain words in a page without an article " * 3 + "</p><p>" + "and a second paragraph of some length " * 3 + "</p>",
     ("plain words in a page without an article " * 3).strip() + "\n" + ("and a second paragraph of some length " * 3).strip()),
    ("<article><p>never closed <div class=sidebar>side</div><p title='a>b'>quoted", "never closed\nquoted"),
    ("", ""), (None, ""), ("<script>only</script>", ""), ("<article>" + "<b>" * 3_000 + "deep", "deep"),
    ("<div class='page has-sidebar'><div class='sidebar'>side</div><article><p>Body text</p></article><section id='comments'>"
     "<article><p>first!</p></article><article class='comment'>me too</article></section></div>", "Body text"),
    ("<div id='wrap-sidebar'><main><h1>T</h1><p>x y z</p><div class='ad-slot'>Buy</div></main></div>", "T\nx y z"),
    ("<div id='header'>Site name here</div><div id='content'><h2>News</h2><p>short one</p><div class='related'>more</div></div>"
     "<div id='footer'>(c)</div>", "News\nshort one"),
    ("<main><nav>m</nav><article><p class='byline'>By A</p><p>t</p><figure><figcaption>cap</figcaption></figure></article><aside>s</aside>"
     "<p>promo outside</p></main>", "By A\nt\ncap"),
    ("<div class='cookie-notice'>We use cookies on this site and so do our partners</div><div class='post'><p>Hello</p><form>f</form>"
     "<div class='commentlist'>c</div></div>", "Hello"),
    ("<article><ul><li>one</li><li>two</li></ul><blockquote>q</blockquote><pre>x  y</pre><table><tr><td>c1</td><td>c2</td></tr></table></article>",
     "one\ntwo\nq\nx y\nc1\nc2"),
    ("<article><h1>T</h1><p>one</p></article><article class='teaser ad'><p>two</p></article>", "T\none"),
    ("<ARTICLE><P>Upper</P></ARTICLE><P>after", "Upper"), ("<article><p hidden>no</p><p style='display:none'>no</p><p>yes</p>", "yes"),
]


def test_main_text(spark):
    rows = [(i, f"http://x/{i}", h, 1) for i, (h, _) in enumerate(PAGES)] + [(None, None, "<article>n", 1), (0, "http://x/0", PAGES[0][0], 1)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    want = [(i, f"http://x/{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(None, None, "n", 1), (0, "http://x/0", PAGES[0][1], len(PAGES[0][1]))]
    assert bag(got) == bag(want)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_of_the_given_pages(spark):
    """Below the title, a page's text is a document's text."""
    docs = {" ".join((r.text or "").split()) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("text").collect()}
    rows = html_text.extract(spark.read.parquet(f"{SF01}/pages.parquet")).collect()
    assert all(" ".join(r.text.partition("\n")[2].split()) in docs and r.n_chars == len(r.text) for r in rows)


def test_tree_fits_its_table():
    tree = html_text.train()
    assert all(html_text.kept(tree, r[:-1]) == bool(r[-1]) for r in html_text.LABELLED)


def test_long_broken_pages_take_linear_time():
    tree = html_text.train()
    for page in ("<" * 100_000, "<p " + "\"" * 1_001 + "x" * 100_000, "<p a='" * 20_000, "<!--" * 30_000, "<script>" * 20_000):
        html_text.main_text(page, tree)


def test_lowering_touches_ascii_only():
    assert lower("AÉZ") == "aÉz" and os.path.exists(PATH)
