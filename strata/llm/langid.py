"""Operator 8: language identification by multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower-case letters with one mark between words; runs of
1 to 3 characters are hashed into a fixed number of buckets.  Learning sums the
bucket counts of each language on the cluster; the log-probability matrix
(languages x buckets) is broadcast, and batches are scored in numpy as one
sparse product: the rows of all grams of a batch are gathered and summed per text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, learning_rows, map_rows

BUCKETS = 1 << 16
#: Learning texts per language, on average over draws of the hash that picks them.
SAMPLE_PER_LANGUAGE = 2_000
UNDETERMINED = "und"
#: Grams gathered at once when scoring; bounds memory for texts of any length.
CHUNK = 1 << 20

_FOLD: list[np.ndarray] = []


def folding() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for anything else; made once per process."""
    if not _FOLD:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _FOLD.append(table)
    return _FOLD[0]


def grams(text: str) -> np.ndarray:
    """Buckets of all character 1-, 2- and 3-grams of a whole text; empty if it has no letter."""
    z = folding()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    z = np.concatenate(([0], z, [0])).astype(np.uint32)
    z = z[np.concatenate(([True], (z[1:] | z[:-1]) != 0))]      # one mark between words
    if len(z) < 3:
        return np.empty(0, np.int32)
    one = z * np.uint32(0x9E3779B1)
    two = one[:-1] * np.uint32(31) + z[1:] * np.uint32(0x85EBCA77) + np.uint32(1)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + z[2:] * np.uint32(0x27D4EB2F) + np.uint32(2)
    out = np.concatenate((one[z != 0], two, three))
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    return (out >> np.uint32(16)).astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray      # buckets x languages
    prior: np.ndarray         # languages

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and posterior of each text."""
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts), bool)
        held, starts, rows, size = [], [], [], 0

        def flush() -> None:
            nonlocal held, starts, rows, size
            if held:
                sums = np.add.reduceat(self.log_prob[np.concatenate(held)], starts, axis=0, dtype=np.float64)
                np.add.at(total, rows, sums)
            held, starts, rows, size = [], [], [], 0

        for i, t in enumerate(texts):
            g = grams(t) if t else ()
            seen[i] = len(g) > 0
            for at in range(0, len(g), CHUNK):
                part = g[at:at + CHUNK]
                held.append(part)
                starts.append(size)
                rows.append(i)
                size += len(part)
                if size >= CHUNK:
                    flush()
        flush()
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        total += self.prior
        total -= total.max(axis=1, keepdims=True)
        p = np.exp(total)
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)       # ties: the first language in alphabetical order
        return ([self.languages[b] if s else UNDETERMINED for b, s in zip(best, seen)],
                [float(p[i, b]) if s else 0.0 for i, (b, s) in enumerate(zip(best, seen))])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from the rows whose crc32(id as text) mod 3 is not 1 and whose language is known.

    ``per_language`` bounds the work: each language is thinned by a hash of the
    id to that many texts on average, all of them if it has fewer.  Gram counts
    are summed on the cluster; the driver gets at most languages x buckets sums.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .filter(learning_rows("id") & F.col("lang").isNotNull()))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    grain = 1 << 20
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(-(-grain * per_language // sizes[k])))])
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(grain)) < share[F.col("lang")])

    def count(batch: dict) -> dict:
        out: dict[str, list] = {"lang": [], "bucket": [], "n": []}
        for lang in sorted(set(batch["lang"])):
            sums = np.zeros(BUCKETS, np.int64)
            for name, text in zip(batch["lang"], batch["text"]):
                if name == lang and text:
                    sums += np.bincount(grams(text), minlength=BUCKETS)
            hit = np.flatnonzero(sums)
            out["lang"] += [lang] * len(hit)
            out["bucket"] += hit.tolist()
            out["n"] += sums[hit].tolist()
        return out

    sums = (map_rows(sample.select("lang", "text"), count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.full((BUCKETS, len(languages)), 0.5)      # smoothing
    if sums.num_rows:
        column = np.searchsorted(languages, np.array(sums["lang"].to_pylist()))
        np.add.at(counts, (sums["bucket"].to_numpy(), column), sums["n"].to_numpy())
    n = np.array([sizes[k] for k in languages], float)
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), np.log(n / n.sum()))


def predictor(docs: DataFrame, model: Model):
    """A column function text -> struct(lang_pred, score), the model broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        lang, score = shared.value.score(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang_pred", "score"])

    predict.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    once = F.arrow_udf(predict, "lang_pred string, score double").asNondeterministic()   # run once, though several columns come from it

    def column(text: str | Column) -> Column:
        return once(F.col(text) if isinstance(text, str) else text)

    return column


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row of ``docs``.

    ``lang_pred`` is a learned language, ``und`` (score 0) where the text is
    null, empty or has no letter, or where no row has a language to learn from.
    Scores are posteriors of the whole text.  Repeated rows and null ids give a
    row each; a null id is not held out and is not learnt from.  An empty table
    gives an empty result; extra columns are not read.  Scoring is a narrow map
    over the scan: nothing is shuffled but the learning counts.
    """
    predict = predictor(docs, learn(docs, id_col, text_col, lang_col, per_language))
    return (docs.select(F.col(id_col).cast("long").alias(id_col), held_out(id_col).alias("held_out"),
                        predict(text_col).alias("p"))
            .select(id_col, "held_out", "p.lang_pred", "p.score"))
