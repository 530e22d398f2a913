"""Operator 1: a quality classifier, a generalised additive model with pairwise interactions.

A text becomes a few counts and ratios.  Boosting goes round the features in
cycles; each step fits a shallow tree to one feature's bins and adds it to that
feature's lookup table.  Then the pairs of features that explain most of what is
left get two-way tables, learnt the same way.  A score is a sum of table
entries: binned once, added up for a whole batch at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, learning_rows, map_rows, utf8

#: Labelled documents learnt from, at most: those of smallest id hash.
MAX_TRAIN = 20_000

FEATURES = ["log_bytes", "log_words", "word_bytes", "distinct_words", "repeated_next", "upper", "digits", "symbols",
            "symbol_pairs", "spaces", "log_line_bytes", "distinct_lines", "log_longest_word", "sentence_ends",
            "lone_symbols", "beyond_ascii"]

_KIND = np.zeros(256, np.uint8)                     # 0 other, 1 upper, 2 lower, 3 digit, 4 symbol, 5 space, 6 beyond ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
_KIND[[9, 10, 11, 12, 13, 32]] = 5


def features(text: bytes) -> list[float]:
    """The features of a whole text (UTF-8); all zero if it is empty."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    kind = _KIND[np.frombuffer(text, np.uint8)]
    by_kind = np.bincount(kind, minlength=7)
    words, lines = text.split(), text.split(b"\n")
    k = max(1, len(words))
    symbol, space = kind == 4, kind == 5
    letters = max(1, by_kind[1] + by_kind[2])
    return [
        np.log1p(n), np.log1p(len(words)), (n - by_kind[5]) / k, len(set(words)) / k, sum(map(eq, words, words[1:])) / k,
        by_kind[1] / letters, by_kind[3] / n, by_kind[4] / n,
        np.count_nonzero(symbol[1:] & symbol[:-1]) / k, by_kind[5] / n, np.log1p(n / len(lines)),
        len(set(lines)) / len(lines), np.log1p(max(map(len, words), default=0)),
        text.count(b". ") / k, np.count_nonzero(symbol[1:-1] & space[:-2] & space[2:]) / k, by_kind[6] / n,
    ]


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, at_least: float) -> np.ndarray:
    """Leaf values per bin of the best tree of ``depth`` on ordered bins, from
    the bins' gradient and hessian sums."""
    out = np.full(len(g), -g.sum() / (h.sum() + ridge))
    if depth and len(g) > 1:
        gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        gain = np.where((hl >= at_least) & (hr >= at_least), gl**2 / (hl + ridge) + gr**2 / (hr + ridge), -1.0)
        best = int(gain.argmax())
        if gain[best] > g.sum() ** 2 / (h.sum() + ridge):
            cut = best + 1
            out[:cut] = shallow_tree(g[:cut], h[:cut], depth - 1, ridge, at_least)
            out[cut:] = shallow_tree(g[cut:], h[cut:], depth - 1, ridge, at_least)
    return out


def cross_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts a two-way grid once each way."""
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b = g.shape
    best, values = -1.0, np.zeros_like(g)
    if a < 2 or b < 2:
        return best, values
    gain, quarters = 0.0, []
    for S in (G, H):
        ll = S[:-1, :-1]
        lr, rl = S[:-1, -1:] - ll, S[-1:, :-1] - ll
        quarters.append((ll, lr, rl, S[-1, -1] - ll - lr - rl))
    gain = sum(q**2 / (w + ridge) for q, w in zip(*quarters))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [-q[i, j] / (w[i, j] + ridge) for q, w in zip(*quarters)]
    values[:i + 1, :j + 1], values[:i + 1, j + 1:], values[i + 1:, :j + 1], values[i + 1:, j + 1:] = v
    return float(gain[i, j]), values


@dataclass
class Additive:
    """Lookup tables per feature and per pair of features."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)          # cuts between bins, per feature
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)          # bin -> coarse bin, for the pairs

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, one row of features each."""
        z = np.full(len(x), self.intercept)
        if self.tables and len(x):
            b = self.bins(x)
            for t, bj in zip(self.tables, b):
                z += t[bj]
            for i, j, t in self.pairs:
                z += t[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 200, rate: float = 0.1, depth: int = 2,
        n_pairs: int = 8, pair_rounds: int = 60, ridge: float = 1.0, at_least: float = 2.0) -> Additive:
    """Cyclic boosting.  With no rows, or one label only, the model is a constant
    (the smoothed share of label 1; 0.5 with no rows)."""
    p = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    model = Additive(float(np.log(p / (1 - p))))
    if not len(y) or y.min() == y.max():
        return model
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    for col in x.T:
        cuts = np.unique(np.quantile(col, quantiles))
        model.edges.append(cuts[cuts > col.min()])
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-z))
        return q - y, q * (1 - q)

    for _ in range(rounds):
        for j, s in enumerate(sizes):
            if s < 2:
                continue
            g, h = slopes()
            step = rate * shallow_tree(np.bincount(b[j], g, s), np.bincount(b[j], h, s), depth, ridge, at_least)
            model.tables[j] += step
            z += step[b[j]]
    model.coarse = [np.arange(s) * min(8, s) // s for s in sizes]
    c = [model.coarse[j][b[j]] for j in range(len(sizes))]
    width = [int(m[-1]) + 1 for m in model.coarse]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        at, n = c[i] * width[j] + c[j], width[i] * width[j]
        return np.bincount(at, g, n).reshape(width[i], -1), np.bincount(at, h, n).reshape(width[i], -1)

    gains = sorted(((cross_tree(*grid(i, j), ridge)[0], i, j) for i in range(len(sizes)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((width[i], width[j]))) for gain, i, j in gains[:n_pairs] if gain > 0]
    for _ in range(pair_rounds):
        for i, j, table in model.pairs:
            step = rate * cross_tree(*grid(i, j), ridge)[1]
            table += step
            z += step[c[i], c[j]]
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = MAX_TRAIN) -> Additive:
    """Learn from at most ``max_train`` labelled documents whose crc32(id as
    text) mod 3 is not 1, those of smallest id hash.  An id with several labels
    counts as 1 if most of them are; an id with several texts counts once, by its
    smallest features.  Only the features of that bounded sample reach the driver."""
    picked = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y"))
              .filter(learning_rows("id") & F.col("y").isNotNull())
              .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_train))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
            .join(F.broadcast(picked), "id"))      # at most max_train rows of two numbers
    made = (map_rows(rows, lambda b: {"id": b["id"], "y": b["y"], "x": list(map(features, b["text"]))},
                     "id long, y int, x array<double>")
            .groupBy("id").agg(F.min(F.struct("y", "x")).alias("v")).select("id", "v.*").orderBy("id").collect())
    return fit(np.array([r["x"] for r in made], float).reshape(len(made), len(FEATURES)), np.array([r["y"] for r in made], float))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    ``score`` is the probability of label 1 from 0 to 1; ``predicted`` is 1 from
    0.5 on.  Null and empty texts are scored like any other, on features that
    are all zero.  Repeated rows and null ids give a row each; a null id is not
    held out and not learnt from.  Without labels every score is 0.5.  An empty
    table gives an empty result; extra columns are not read.  Scoring is a
    narrow map over the scan.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col, label_col, max_train))

    def run(batch: dict) -> dict:
        x = np.array(list(map(features, batch["text"])), float).reshape(-1, len(FEATURES))
        score = model.value.score(x)
        return {"id": batch["id"], "held_out": batch["held_out"], "score": score, "predicted": (score >= 0.5).astype(int)}

    src = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), utf8(text_col).alias("text"))
    return (map_rows(src, run, "id long, held_out boolean, score double, predicted int")
            .withColumnRenamed("id", id_col))
