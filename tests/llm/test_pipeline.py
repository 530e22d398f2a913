"""The corpus pipeline against plain re-computations of its stages, and the registered queries."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from strata.llm import langid
from strata.llm.common import prepare, read_table, written

from .helpers import VOCABULARY, bag, no_documents, odd_documents
from .test_pairs import decontaminated, plain_components, plain_fingerprint, windows
from .test_texts import check_packing

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


def plain_stages(rows, items):
    """What the stages keep of (doc_id, text, lang, source, n_chars) rows."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    yield "language ID", rows
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows}
    group = plain_components(list(fps.items()))
    rows = [r for r in rows if group[fps[r[0]]] == r[0]]
    yield "SimHash near-dedup", rows
    first = {}
    for d, t, *_ in rows:
        t = t.encode()
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], 1 << 62), d)
    kept = []
    for d, t, lang, source, n in rows:
        b = t.encode()
        cut = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                cut[i:i + 50] = b"\1" * 50
        if any(cut):
            t = bytes(x for x, c in zip(b, cut) if not c).decode("utf-8", "ignore")
            n = len(t)
        if t.strip(" ") or not any(cut):
            kept.append((d, t, lang, source, n))
    yield "suffix-array dedup", kept
    pats = windows(items)
    by_first = collections.defaultdict(dict)
    for p, names in pats.items():
        by_first[p[0]][p] = names
    from .helpers import words
    kept = [r for r in kept if not decontaminated(r[1], {p: n for w in set(words(r[1])) for p, n in by_first.get(w, {}).items()})[1]]
    yield "benchmark decontamination", kept


def test_every_stage_equals_its_plain_form(spark):
    docs = read_table(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF001, "benchmark").collect()]
    for (name, stage), (plain, want) in zip(C.STAGES, plain_stages(rows, items)):
        assert name == plain
        docs = written(stage(spark, docs, SF001), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert bag(docs.collect()) == bag(want), name
    packed = C.STAGES[-1][1](spark, docs, SF001).collect()
    check_packing(packed, want, Tokenizer.from_file(public_tokenizers.path(VOCABULARY)))
    assert bag(C.run(spark, SF001).select("doc_id", "start", "length", "ids_crc32").collect()) == bag((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed)


@pytest.mark.parametrize("clash", [False, True])
def test_stages_take_odd_documents(spark, clash):
    docs = odd_documents(spark, clash)
    columns = docs.columns
    for name, stage in C.STAGES[:-1]:
        docs = written(stage(spark, docs, SF001), "stage")
        assert docs.columns == columns, name
    assert docs.filter("text IS NULL OR trim(text) = ''").count() == 0 and docs.count() > 10
    assert C.STAGES[-1][1](spark, docs, SF001).count() >= docs.count()


def test_stages_take_no_documents(spark):
    for name, stage in C.STAGES:
        assert stage(spark, no_documents(spark), SF001).count() == 0, name


def test_language_stage_fills_but_never_changes_lang(spark):
    docs = odd_documents(spark)
    rows = C.identify_language(spark, docs, SF001).collect()
    given = {(d, t): l for d, t, l, *_ in (tuple(r) for r in docs.collect())}
    assert all(r.lang == given[r.doc_id, r.text] or given[r.doc_id, r.text] is None and r.lang != langid.UNDETERMINED for r in rows)
    nothing = C.identify_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF001)
    assert bag(r.text for r in nothing.collect()) == bag(r.text for r in rows)


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and [n for n, _ in C.STAGES] == [
        "language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]


def test_the_last_stage_remembers_less_and_packs_the_same(spark, tmp_path, monkeypatch):
    """A worker of the pipeline holds what other stages need too."""
    from strata.llm import packing
    asked, real = [], packing.pack
    monkeypatch.setattr(packing, "pack", lambda *a, **k: (asked.append(k.get("remembered")), real(*a, **k))[1])
    docs = spark.createDataFrame([(i, f"word{i % 7} und so weiter {i}" * (i % 40)) for i in range(60)], "doc_id long, text string")
    packed = C.pack_documents(spark, docs, str(tmp_path))
    assert asked and 0 < asked[0] <= packing.REMEMBERED // 4
    whole = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    few = real(docs, public_tokenizers.path(VOCABULARY), remembered=3)
    more = real(docs, public_tokenizers.path(VOCABULARY))
    assert bag(packed.select(*whole).collect()) == bag(few.select(*whole).collect()) == bag(more.select(*whole).collect())
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        spec = f.read()
    assert packing.encoder_of(spec, 3).ids.size == 3 and packing.encoder_of(spec).ids.size == packing.REMEMBERED
