"""The registered queries of the training-data operators, and SQL where SQL can say the same.

Each query applies its operator, with production parameters, to its whole
table and derives the digest columns from the operator's own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, dialogue, html_text, jaccard, langid, licenses, lpf, negatives, packing, quality, simhash, vafile
from .common import prepare, read_table
from .oracles import ORACLES  # noqa: F401

VOCABULARY = "byte_bpe_50k.json"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = read_table(spark, sf_dir, "embeddings")
    return vafile.top_k(rows, rows.filter(F.col("vec_id") % vafile.QUERY_EVERY == 0))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "found.n_words", decontam.n_hit().alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
                        (F.size("found.hits") > 0).alias("contaminated"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return lpf.remove_copies(docs).select(
        "doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dialogue.repair(dialogue.damaged(read_table(spark, sf_dir, "conversations")))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = negatives.relabelled(read_table(spark, sf_dir, "embeddings"))
    return negatives.mine(rows, rows.filter(F.col("vec_id") % negatives.ANCHOR_EVERY == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_top_k": op2_top_k,
    "op3_decontamination": op3_decontamination,
    "op4_licenses": op4_licenses,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_main_text": op9_main_text,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_hard_negatives": op13_hard_negatives,
}

