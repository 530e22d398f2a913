"""Operator 13: hard negatives from candidate blocks in Hilbert order with zone maps.

Candidates are put in the order of (label, place on a Hilbert curve through all
their dimensions) and written as Parquet rows of one block each: the packed
vectors beside a zone map, the least and largest component of every dimension and
the least and largest label.  Interval arithmetic on a zone map bounds the inner
products of an anchor with everything in the block, so only blocks that can hold
one of an anchor's positives, and then only those that can hold a score inside one
of its windows, have their vectors read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written
from .vafile import exact, integers

POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
RELABEL_EVERY, LABELS, ANCHOR_EVERY = 7, 10, 50
#: Rows of a block, and bits of each dimension on the Hilbert curve.
BLOCK, CURVE_BITS = 256, 4
#: Anchors broadcast at once, at most.
ANCHOR_BLOCK = 2_048
EXACT = 2.0**53


def hilbert_key(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row (whole numbers below 2**bits in every dimension) on a
    Hilbert curve, as bytes in the curve's order: rotations and reflections are
    undone from the highest bit down, then the Gray code."""
    x = cells.astype(np.int64).T.copy()                    # one row a dimension
    n = len(x)
    if not n:
        return [b""] * cells.shape[0]
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    x ^= flip
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])        # highest bits of all dimensions first
    return [r.tobytes() for r in np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)]


def _curve(bits: int, reach: float):
    """Adds the Hilbert key of each vector; ``reach`` is the largest component of all rows, without its sign."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            keys: list = [b""] * len(col)
            flat, off = col.values.to_numpy(), col.offsets.to_numpy()
            sizes = np.diff(off)
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                v = flat[(off[at][:, None] + np.arange(n)).astype(np.int64)].reshape(len(at), n)
                cells = np.clip((v / reach + 1) * (1 << (bits - 1)), 0, (1 << bits) - 1)
                for i, key in zip(at, hilbert_key(cells.astype(np.int64), bits)):
                    keys[i] = key
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("dim", "label", "vec_id", "v")), pa.array(keys, pa.binary())],
                                             names=["dim", "label", "vec_id", "v", "curve"])

    return run


_BLOCKS = ("block string, dim int, n int, label_low long, label_high long, low array<double>, high array<double>, "
           "ids binary, labels binary, narrow boolean, vectors binary")


def _pack(block_rows: int):
    """Rows in order -> one row a block; vectors as 16-bit integers where they fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            dim = rows[0][0]
            labels, ids = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
            v = np.array([r[3] for r in rows], float).reshape(len(rows), dim)
            narrow = bool(np.abs(v).max(initial=0) < 2**15)
            number += 1
            made = [f"{task}-{number}", dim, len(rows), int(labels.min()), int(labels.max()), v.min(axis=0).tolist(), v.max(axis=0).tolist(),
                    ids.tobytes(), labels.tobytes(), narrow, (v.astype(np.int16) if narrow else v).tobytes()]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()),
                     pa.binary(), pa.binary(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, types)],
                                              names=[f.split()[0] for f in _BLOCKS.split(", ")])

        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("dim", "label", "vec_id", "v"))):
                if held and (row[0] != held[0][0] or len(held) >= block_rows):
                    yield packed(held)
                    held = []
                held.append(row)
        if held:
            yield packed(held)

    return run


def index(rows: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """The candidate blocks of ``rows`` (vec_id, label, v), written once to the shared folder.
    Every row stands in one block, in the order of label and Hilbert curve."""
    size = F.size("v").alias("dim")
    reach = rows.agg(F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).first()[0] or 1.0
    keyed = rows.select(size, "label", "vec_id", "v").mapInArrow(
        _curve(CURVE_BITS, reach), "dim int, label long, vec_id long, v array<double>, curve binary")
    order = ("dim", "label", "curve", "vec_id")
    return written(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack(block_rows), _BLOCKS), "candidate-blocks")


class Anchors:
    """Some anchors of one length: ids, labels, whole-number vectors, and the
    windows (smallest and largest score) in which each looks for rows."""

    def __init__(self, rows: list[dict], dim: int):
        self.ids, self.labels = (np.array([r[c] for r in rows], np.int64) for c in ("vec_id", "label"))
        self.vectors = np.array([r["v"] for r in rows], float).reshape(len(rows), dim)
        self.positives = [[(x["vec_id"], x["score"]) for x in r["positives"] or []] if "positives" in r else [] for r in rows]
        self.floor = np.array([-np.inf if r.get("floor") is None else r["floor"] for r in rows], float)        # scores known to be reached
        self.up, self.down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each anchor with a point of the zone."""
        least, most = self.up @ low + self.down @ high, self.up @ high + self.down @ low
        slack = 1e-9 * (np.abs(least) + np.abs(most)) if max(np.abs(least).max(initial=0), np.abs(most).max(initial=0)) > EXACT / 4 else 0.0
        return least - slack, most + slack


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Whole scores s with low * score <= 100 * s <= high * score; none if the second is smaller."""
    return -(-low * score // 100), high * score // 100


def _zones(shared, select):
    """Zone maps only: the blocks that some anchor must read, with the numbers of those anchors."""
    schema = pa.schema([("block", pa.string()), ("asked", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {d: (a, {}) for d, a in shared.value.items()}
        for b in batches:
            out = []
            for block, dim, n, label_low, label_high, low, high in zip(*(b.column(i).to_pylist() for i in range(7))):
                if dim in sides:
                    anchors, state = sides[dim]
                    asked = np.flatnonzero(select(anchors, n, label_low, label_high, *anchors.bounds(np.array(low), np.array(high)), state))
                    if len(asked):
                        out.append((block, asked.astype(np.int32).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=schema)

    return run


def _likeliest(shared):
    """Zone maps only: of this task's blocks that may hold an anchor's label the one of the
    highest upper bound, for each anchor."""
    schema = pa.schema([("block", pa.string()), ("asked", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = {d: (a, np.full(len(a.ids), -np.inf), np.full(len(a.ids), None, object)) for d, a in shared.value.items()}
        for b in batches:
            for block, dim, n, label_low, label_high, low, high in zip(*(b.column(i).to_pylist() for i in range(7))):
                if dim in sides:
                    anchors, most, where = sides[dim]
                    upper = anchors.bounds(np.array(low), np.array(high))[1]
                    better = (upper > most) & (anchors.labels >= label_low) & (anchors.labels <= label_high)
                    most[better], where[better] = upper[better], block
        asked: dict[str, list[int]] = {}
        for _, _, where in sides.values():
            for i, block in enumerate(where):
                if block is not None:
                    asked.setdefault(block, []).append(i)
        if asked:
            yield pa.RecordBatch.from_arrays([pa.array(list(asked)), pa.array([np.array(x, np.int32).tobytes() for x in asked.values()])], schema=schema)

    return run


_FOUND = "anchor_id long, place int, vec_id long, score long"
_FOUND_ARROW = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Best:
    """The k best (score, id) of each key: falling scores, then rising ids."""

    def __init__(self, k: int):
        self.k, self.rows = k, {}

    def floor(self, key) -> float:
        rows = self.rows.get(key, ())
        return rows[-1][0] if len(rows) == self.k else -np.inf

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:                       # ties with the k-th stay in
            near = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[near], ids[near]
        self.rows[key] = sorted([*self.rows.get(key, ()), *zip(scores.tolist(), ids.tolist())], key=lambda x: (-x[0], x[1]))[:self.k]


def _read(shared, k: int, positives: bool, low: int, high: int):
    """The vectors of the asked blocks, block by block: the k best positives of each
    anchor, or the k best rows of each of its windows, that this task holds."""
    def scores(anchors: Anchors, i: int, vectors: np.ndarray) -> np.ndarray:
        return np.array(exact(vectors, anchors.vectors[i]), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for b in batches:
            for dim, lows, highs, ids, labels, narrow, packed, asked in zip(*(b.column(c).to_pylist() for c in (
                    "dim", "low", "high", "ids", "labels", "narrow", "vectors", "asked"))):
                anchors = shared.value[dim]
                least, most = anchors.bounds(np.array(lows), np.array(highs))
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                vectors = np.frombuffer(packed, np.int16 if narrow else float).reshape(len(ids), dim).astype(float)
                for i in np.frombuffer(asked, np.int32):
                    own = int(anchors.ids[i])
                    if positives:
                        if most[i] < max(anchors.floor[i], best.floor((own, 0))):
                            continue                  # what this task has read beats the whole block
                        take = (labels == anchors.labels[i]) & (ids != own)
                        if take.any():
                            best.add((own, 0), scores(anchors, i, vectors[take]), ids[take])
                        continue
                    windows = [(p, *window(s, low, high)) for p, (_, s) in enumerate(anchors.positives[i])]
                    windows = [(p, a, z) for p, a, z in windows if a <= z and least[i] <= z and most[i] >= max(a, best.floor((own, p)))]
                    take = labels != anchors.labels[i]
                    if not windows or not take.any():
                        continue
                    made, of = scores(anchors, i, vectors[take]), ids[take]
                    for p, a, z in windows:
                        inside = (made >= a) & (made <= z)
                        if inside.any():
                            best.add((own, p), made[inside], of[inside])
        out = [(own, p, v, s) for (own, p), rows in best.rows.items() for s, v in rows]
        for at in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 10_000]), _FOUND_ARROW)], schema=_FOUND_ARROW)

    return run


def _for_positives(anchors: Anchors, n: int, label_low: int, label_high: int, least, most, state) -> np.ndarray:
    """Blocks that may hold a row of the anchor's label at or above the score it is sure of."""
    return (anchors.labels >= label_low) & (anchors.labels <= label_high) & (most >= anchors.floor)


def _for_windows(low: int, high: int):
    def select(anchors: Anchors, n: int, label_low: int, label_high: int, least, most, state) -> np.ndarray:
        if "windows" not in state:
            ranges = [[w for _, s in p if (w := window(s, low, high))[0] <= w[1]] for p in anchors.positives]
            width = max(map(len, ranges), default=0)
            state["windows"] = np.array([r + [(1, 0)] * (width - len(r)) for r in ranges], float).reshape(len(ranges), width, 2)
        w = state["windows"]
        meets = ((w[:, :, 0] <= w[:, :, 1]) & (least[:, None] <= w[:, :, 1]) & (most[:, None] >= w[:, :, 0])).any(axis=1)
        return meets & ~((anchors.labels == label_low) & (label_low == label_high))

    return select


def _blocks_of(df: DataFrame, at_once: int) -> int:
    """Into how many parts anchors must be dealt by their hash so that no part has more than ``at_once``."""
    n = df.count()
    if not n:
        return 0
    parts = 1
    while True:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
        if df.groupBy(block).count().agg(F.max("count")).first()[0] <= at_once:
            return parts
        parts *= 2


def _search(blocks: DataFrame, anchors: DataFrame, parts: int, choose, k: int, positives: bool, low: int, high: int, name: str) -> DataFrame:
    """(anchor_id, place, vec_id, score, rank): the k best of every anchor and window, part by part,
    in the blocks that ``choose`` names from the zone maps."""
    spark = blocks.sparkSession
    path, zones = scratch_path(spark, name), ("block", "dim", "n", "label_low", "label_high", "low", "high")
    for p in range(parts):
        sides: dict[int, list] = {}
        for r in anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == p).orderBy("vec_id").collect():
            sides.setdefault(len(r["v"]), []).append(r.asDict())
        shared = spark.sparkContext.broadcast({d: Anchors(rows, d) for d, rows in sides.items()})
        chosen = written(blocks.select(*zones).mapInArrow(choose(shared), "block string, asked binary"), "chosen-blocks", free=False)
        read = blocks.join(chosen, "block").mapInArrow(_read(shared, k, positives, low, high), _FOUND)
        order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "vec_id")
        (read.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).write.parquet(f"{path}/part={p}"))
        shared.destroy()
    schema = f"{_FOUND}, rank int"
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema + ", part int").parquet(path).drop("part")


def mine(candidates: DataFrame, anchors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchor_block: int = ANCHOR_BLOCK, block_rows: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for each anchor and each of its ``positives`` best rows of its own label, the
    ``negatives`` best rows of other labels whose score lies between ``low`` % and
    ``high`` % of the positive's.  Scores are inner products of floor(256 * x);
    higher ones come first, ties by the smaller id.

    Rows whose id, label or vector is null, or whose vector holds a null or
    non-finite component, take no part; vectors are compared with those of their
    own length.  Rows of the anchor's id are none of its positives.  An anchor id that is repeated
    is asked once, with its smallest label and vector; candidates that are
    repeated are candidates each.  An empty table gives an empty result; extra
    columns are not read.

    Anchors go in parts of at most ``anchor_block``, each broadcast.  Zone maps are read
    without the vectors and choose the blocks; vectors of other blocks reach no task.
    """
    def rows(df: DataFrame) -> DataFrame:
        kept = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("long").alias("label"))
        return integers(kept.filter("label IS NOT NULL"), "vec_id", "vector", "label")

    blocks = index(rows(candidates), block_rows)
    asked = written(rows(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("first"))
                    .select("vec_id", "first.label", "first.v"), "anchors", free=False)
    parts = _blocks_of(asked, anchor_block)
    # the likeliest block of each task first: its k-th score is a floor for the search proper
    first = _search(blocks, asked, parts, _likeliest, positives, True, low, high, "floors")
    floors = first.filter(F.col("rank") == positives).select(F.col("anchor_id").alias("vec_id"), F.col("score").alias("floor"))
    asked = written(asked.join(floors, "vec_id", "left"), "anchors-with-floors", free=False)
    best = _search(blocks, asked, parts, lambda shared: _zones(shared, _for_positives), positives, True, low, high, "positives")
    own = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.expr(
        "transform(array_sort(collect_list(struct(rank, vec_id AS positive_id, score))), x -> struct(x.positive_id AS vec_id, x.score))").alias("positives"))
    paired = written(asked.join(own, "vec_id"), "anchors-with-positives", free=False)
    found = _search(blocks, paired, parts, lambda shared: _zones(shared, _for_windows(low, high)), negatives, False, low, high, "negatives")
    # a row is one anchor, one of its positives by place, and a negative
    positive = best.select("anchor_id", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (found.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(positive, ["anchor_id", "place"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(df: DataFrame, id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """Every seventh id carries the next label, so some labels are wrong on purpose."""
    label = F.col(label_col).cast("long")
    return df.withColumn(label_col, F.when(F.col(id_col) % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label))
