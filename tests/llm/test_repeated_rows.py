"""Repeated ids and repeated rows in operators 7 and 10."""

import collections
import random

import public_tokenizers
import pytest

from strata.llm import packing, simhash
from strata.llm.common import prepare

from .helpers import VOCABULARY, bag, prose


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


def test_an_id_on_unrelated_texts_stays_in_each_group(spark):
    rng = random.Random(8)
    a, b, c = (prose(rng, 200) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (1, b, "y"), (2, a, "x"), (3, b, "x"), (0, c, "x"), (1, c, "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert bag(simhash.one_of_each(docs).collect()) == bag([(1, a, "x"), (1, b, "x"), (0, c, "x"), (None, a, "x")])


def test_equal_pieces_are_dealt_over_the_groups(spark):
    docs = spark.createDataFrame([(None, "")] * 4_000, "doc_id long, text string").repartition(3)
    rows = packing.pack(docs, public_tokenizers.path(VOCABULARY), group_pieces=500).collect()
    groups = collections.Counter(r.sequence_id // 2 % 8 for r in rows)
    assert sum(groups.values()) == 4_000 and len(groups) == 8 and max(groups.values()) < 750
