"""Small tables and plain re-computations for the tests of the training-data operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that documents may bring along under names the operators use inside.
CLASH = ("id score spans kept found lpf_doc lpf_tag lpf_runs lpf_cut text_hash place row words held_out grp h key fp "
         "component_id fingerprint sequence_id offset length start label template").split()

VOCABULARY = "byte_bpe_50k.json"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def prose(rng: random.Random, n: int, syllables="the an on er ing is wh re ti ble".split()) -> str:
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = [
        (1, shared, "en", "a", 1), (2, shared, "en", "a", 1), (2, shared, "en", "a", 1), (3, "x " + shared + " y", "en", None, None),
        (4, None, "en", "a", 0), (5, "", "fr", "a", 0), (6, " \n\t ", None, "a", 0), (7, "123 456", "en", "b", 7),
        (None, shared + " tail", "en", "a", 1), (None, None, None, None, None), (None, "ein haus für der und die", "de", "a", 1),
        (8, "É" * 40 + shared + "é", "fr", "a", 1), (9, "word", "en", "a", 4), (10, "Two Words", "en", "a", 4),
        (11, prose(rng, 30_000), "en", "a", 4), (12, "ab" * 2_000, None, "a", 4), (13, "a" * 5_000 + " " + shared, "en", "a", 4),
        (14, "der die und das ist für einen haus garten schön", "de", "b", 1), (15, "le la les est une maison été forêt", "fr", "b", 1),
        (16, "der garten und das haus ist schön für die", "de", "b", 1), (17, "une forêt est la maison le été les", "fr", "b", 1),
        (18, "MIT License! Apache License, general public license; MIT LICENSE", "en", "c", 1),
        (19, "a<|endoftext|>b  <|endoftext|>", "en", "c", 1), (-20, shared[20:200], "en", "c", 1), (2**40, "\u0000\u0001 ok 　 ok 🙂", "en", "c", 1),
    ]
    return rows


def odd_documents(spark, clash: bool = False, seed: int = 1):
    df = spark.createDataFrame(odd_rows(seed), SCHEMA).repartition(3)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASH]) if clash else df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
