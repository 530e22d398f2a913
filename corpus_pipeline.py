"""The corpus pipeline: five stages over ``documents``, each calling one training-data operator.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, lpf, packing, simhash
from strata.llm.common import fresh, prepare, read_table, written

VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokens that a worker keeps, about 50 MB of them: it goes on to hold what the other stages need.
REMEMBERED = packing.REMEMBERED // 4


def columns_of(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null, empty, no letter) go; a missing
    ``lang`` is filled with the prediction.  If no document has a language to
    learn from, only texts without a letter go."""
    prepare(spark)
    model = langid.learn(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = fresh(docs, "found")
    named = docs.withColumn(found, langid.predictor(docs, model)("text")).filter(F.col(f"{found}.lang_pred") != langid.UNDETERMINED)
    return named.withColumn("lang", F.coalesce("lang", f"{found}.lang_pred")).select(*columns_of(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays, the one of smallest id."""
    prepare(spark)
    return simhash.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of 50-byte strings are cut out of the texts (with what is
    left of a character cut in two), ``n_chars`` follows; a document of which
    nothing but white space is left goes.  Untouched documents stay as they are."""
    prepare(spark)
    spans, kept = fresh(docs, "spans"), fresh(docs, "kept")
    cut = F.size(spans) > 0
    rows = lpf.remove_copies(docs, spans_col=spans, kept_col=kept, as_text=True).filter(~cut | (F.trim(kept) != ""))
    return (rows.withColumn("text", F.when(cut, F.col(kept)).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(cut, F.length(kept).cast("long")).otherwise(F.col("n_chars")))
            .select(*columns_of(docs)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    prepare(spark)
    found = fresh(docs, "found")
    rows = decontam.find(docs, read_table(spark, sf_dir, "benchmark"), out_col=found)
    return rows.filter(F.size(f"{found}.hits") == 0).select(*columns_of(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document, cut and packed into training sequences."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), remembered=REMEMBERED)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
