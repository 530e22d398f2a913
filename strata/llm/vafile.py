"""Operator 2: exact top-k search with vector approximations.

Vectors are integers, floor(256 * x).  The candidates are split into blocks.
Within a block every component is quantised to a cell of fixed width; one
product with the cells' lower corners gives every query an upper and a lower
bound of its score with every candidate.  Only candidates whose upper bound
reaches the k-th best lower bound are kept, and their exact vectors are read in
the order of falling upper bounds until the k-th best exact score is certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written

K = 5
SCALE = 256
QUERY_EVERY = 50
#: Cells per component are 2**CELL_BITS integers wide.
CELL_BITS = 3
#: Queries broadcast at once, at most, and candidates approximated at once.
QUERY_BLOCK = 2_048
BLOCK = 4_096
#: Exact vectors read at once.
READ = 16
#: Products up to here are exact in double precision.
EXACT = 2.0**53


def integers(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """(vec_id long, ``more`` columns, v array<double>): whole-number components.  Rows with a
    null id, a null vector, or a null or non-finite component are left out."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return (df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), *more, v.alias("v")))


class Best:
    """The k best (score, id) of each query so far: falling scores, then rising ids."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [[] for _ in range(queries)]

    def floor(self, q: int) -> float:
        """A candidate below this score can't be among the k best."""
        return self.rows[q][-1][0] if len(self.rows[q]) == self.k else -np.inf

    def add(self, q: int, scores, ids) -> None:
        self.rows[q] = sorted([*self.rows[q], *zip(scores, ids)], key=lambda x: (-x[0], x[1]))[:self.k]


def exact(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    """Inner products of whole numbers, exact whatever their size."""
    if len(query) and np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * len(query) < EXACT:
        return (vectors @ query).astype(np.int64).tolist()
    whole = [int(x) for x in query]
    return [sum(int(a) * b for a, b in zip(row, whole)) for row in vectors]


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best,
                 numbers: np.ndarray, bits: int = CELL_BITS) -> None:
    """Bring the best of ``queries`` (rows ``numbers`` of ``best``) up to date with one block of candidates."""
    width = float(1 << bits)
    low = np.floor(vectors / width) * width                     # lower corners of the cells
    middle = queries @ low.T
    up = (np.maximum(queries, 0) * (width - 1)).sum(axis=1)     # most and least that the rest of a cell adds
    down = (np.minimum(queries, 0) * (width - 1)).sum(axis=1)
    slack = np.abs(middle) * 1e-12 if np.abs(middle).max(initial=0) >= EXACT / 4 else 0.0
    upper = middle + up[:, None] + slack
    k = best.k
    for i, q in enumerate(numbers):
        own = ids == query_ids[i]
        bound = upper[i]
        floor = best.floor(q)
        if len(ids) > k + 1:
            lower = np.where(own, -np.inf, bound - up[i] + down[i] - 2 * (slack if np.isscalar(slack) else slack[i]))
            floor = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k])
        near = np.flatnonzero((bound >= floor) & ~own)
        near = near[np.argsort(-bound[near], kind="stable")]
        for at in range(0, len(near), READ):
            part = near[at:at + READ]
            if bound[part[0]] < best.floor(q):                  # no later one can come in
                break
            best.add(q, exact(vectors[part], queries[i]), ids[part].tolist())


def _scan(shared, k: int):
    """Candidates of a task, block by block, against the broadcast queries: (query_id, vec_id, score) of its best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors = shared.value
        best = Best(len(query_ids), k)
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_length.setdefault(len(v), []).append(i)
        sides = {n: (np.array(at), query_ids[at], np.array([vectors[i] for i in at]).reshape(len(at), n)) for n, at in by_length.items()}
        held: dict[int, list] = {n: [] for n in sides}

        def flush(n: int) -> None:
            if held[n]:
                numbers, qid, q = sides[n]
                search_block(np.concatenate([i for i, _ in held[n]]), np.concatenate([v for _, v in held[n]]), qid, q, best, numbers)
                held[n] = []

        for b in batches:
            ids, col = b.column(0).to_numpy(), b.column(1)
            flat, off = col.values.to_numpy(), col.offsets.to_numpy()
            lengths = np.diff(off)
            for n in sides:
                at = np.flatnonzero(lengths == n)
                if len(at):
                    held[n].append((ids[at], flat[(off[at][:, None] + np.arange(n)).astype(np.int64)].reshape(len(at), n)))
                    if sum(len(i) for i, _ in held[n]) >= BLOCK:
                        flush(n)
        for n in sides:
            flush(n)
        out = [(int(query_ids[q]), int(v), int(s)) for q, rows in enumerate(best.rows) for s, v in rows]
        for at in range(0, len(out), 10_000):
            part = list(zip(*out[at:at + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["query_id", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's ``k`` candidates of
    highest inner product of floor(256 * x), all of them if there are fewer;
    ties go to the smaller vec_id.  The query's own id is no candidate.

    Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part; vectors are compared with those of their own
    length.  A query id that is repeated is asked once, with its smallest vector;
    candidates that are repeated are candidates each.  An empty table gives an
    empty result; extra columns are not read.

    Queries go in blocks of at most ``query_block`` (checked by counting), each
    broadcast and held against all candidates in one narrow scan; a task sends
    on its k best per query only.  Several blocks run one after another, each
    written to the shared folder.
    """
    spark = candidates.sparkSession
    rows = integers(candidates, id_col, vector_col)
    asked = written(integers(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n, parts = asked.count(), 1
    while n:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(parts))
        if asked.groupBy(block).count().agg(F.max("count")).first()[0] <= query_block:
            break
        parts *= 2
    schema = "query_id long, vec_id long, score long"

    def scan(p: int):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == p).orderBy("vec_id").collect()
        shared = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in own], np.int64), [np.array(r["v"], float) for r in own]))
        return rows.mapInArrow(_scan(shared, k), schema), shared

    if parts == 1:
        found = scan(0)[0]
    else:        # one job a block, so that one block's queries are in memory at a time
        path = scratch_path(spark, "top-k")
        for p in range(parts):
            block, shared = scan(p)
            block.write.parquet(f"{path}/block={p}")
            shared.destroy()
        found = spark.read.schema(schema + ", block int").parquet(path).drop("block")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
