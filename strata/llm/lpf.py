"""Operator 5: removal of repeated byte strings with longest-previous-factor arrays.

A place of a text is a later copy when its longest previous factor, the longest
string there that also starts in a document with a smaller id, has ``length``
bytes or more.  In suffix order the best earlier match of a suffix is its
nearest neighbour above or below with a smaller document id (previous and next
smaller values), so two comparisons decide each place.

One suffix order over a whole corpus does not fit one machine, so the suffixes
are dealt out so that any two sharing their first ``length`` bytes meet:

1. A suffix goes by the smallest hash among the ``GRAM``-byte strings within its
   first ``length`` bytes, which is the same for equal beginnings.  Neighbouring
   places mostly share it, so they travel together as one run.
2. Runs of equal bytes collapse: all but those of the smallest document are
   copies as a whole.  What is left needs an order only where several different
   runs meet under one hash; a few percent of all runs.
3. The bytes of those runs are fetched, and their suffixes are dealt out again, now
   by the smallest hash among strings of nearly ``length`` bytes.  The shorter runs
   that come of it collapse where their bytes are equal; again only different
   runs that meet go on.
4. Their suffixes, cut at ``length`` bytes, are put in order: a block of neighbouring
   groups at a time, where previous and next smaller documents decide, and what
   the blocks leave over all blocks, by Spark's sort.  There the first row of equal
   strings is the nearest smaller one of all that follow.

Each group of any size takes this one way, with a constant state beside the sorts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, utf8, written

LENGTH = 50
GRAM = 20
#: How much shorter than the wanted length the strings of the second dealing are.
CLOSER = 10
#: Places in one run at most, and bits that hold a run's length.
RUN_BITS = 10
RUN = 1 << RUN_BITS
#: Bits for the start of a run (texts below 2 GB) and for the tag that tells rows of one id apart.
START_BITS, TAG_BITS = 31, 22
#: Bytes of one text looked at together, and of several texts between two map-side combines.
PIECE = 1 << 20
COMBINE = 8 << 20
#: Runs that a task deals out or puts in order together.
ORDER_ROWS = 5_000

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's root and of its inverse, to ``n``."""
    if not _POWERS or len(_POWERS[0]) < n:
        both = []
        for r in (_ROOT, _INVERSE):
            p = np.full(max(n, 1 << 16), r, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k``-byte string: pairs of equal halves are mixed up to the largest power of two,
    then two overlapping halves."""
    h, size = (a.astype(np.uint64) + np.uint64(1)) * _ROOT, 1
    h ^= h >> np.uint64(29)
    while 2 * size <= k:
        h = h[:-size] * np.uint64(0xD6E8FEB86659FD93) + h[size:]
        h ^= h >> np.uint64(32)
        size *= 2
    if size < k:
        h = h[:len(h) - (k - size)] * np.uint64(0xA0761D6478BD642F) + h[k - size:]
        h ^= h >> np.uint64(31)
    return h * _ROOT


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (width - size)], h[width - size:]) if size < width else h


def runs_of(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of a text, piece by piece: (smallest hash, hash of the run's
    bytes, start, places).  A run of p places stands for the p suffixes that
    begin in it, cut at ``length`` bytes, so its bytes are p + length - 1."""
    whole = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, PIECE):
        a = whole[at:at + PIECE + length - 1]
        least = sliding_least(gram_hashes(a, gram), length - gram + 1)
        begin = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        places = np.diff(begin, append=len(least))
        if places.max() > RUN:                     # long runs (one string over and over) are cut
            parts = -(-places // RUN)
            within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            begin, places = np.repeat(begin, parts) + within * RUN, np.minimum(RUN, np.repeat(places, parts) - within * RUN)
        power, inverse = _powers(len(a) + 1)
        sums = np.concatenate(([np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(7)) * power[:len(a)])))
        key = (sums[begin + places + (length - 1)] - sums[begin]) * inverse[begin]
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + places.astype(np.uint64)
        yield least[begin], key, begin + at, places


def packed(tag: np.ndarray | int, start: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A run as one non-negative long: the row's tag, where it starts, how many places."""
    return (np.int64(tag) << np.int64(START_BITS + RUN_BITS)) | (start.astype(np.int64) << np.int64(RUN_BITS)) | (places.astype(np.int64) - 1)


def _runs_sql(col: str = "run") -> dict[str, str]:
    return {"tag": f"shiftright({col}, {START_BITS + RUN_BITS})",
            "start": f"(shiftright({col}, {RUN_BITS}) & {(1 << START_BITS) - 1}L)",
            "places": f"(({col} & {RUN - 1}L) + 1)"}


_RUNS = pa.schema([(c, pa.int64()) for c in ("h", "key", "doc", "run")])


def _find_runs(length: int, gram: int):
    """Scan: the runs of whole texts.  Runs that a smaller document of the same
    few megabytes holds too are decided on the spot: ``run`` is then negative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], []]
        size = 0

        def combined() -> pa.RecordBatch:
            h, key, doc, r = map(np.concatenate, held)
            order = np.lexsort((r, doc, key, h))
            h, key, doc, r = h[order], key[order], doc[order], r[order]
            again = np.concatenate(([False], (r[1:] == r[:-1]) & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1])))
            h, key, doc, r = h[~again], key[~again], doc[~again], r[~again]       # rows that are there twice
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (key[1:] != key[:-1])))
            first = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
            copy = doc > first
            r = np.where(copy, -1 - r, r)
            h = np.where(copy, (r.view(np.uint64) * _ROOT).view(np.int64), h.view(np.int64))   # spread over the partitions
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (h, np.where(copy, 0, key.view(np.int64)), doc, r)], schema=_RUNS)

        for b in batches:
            for doc, tag, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if len(text) < length:
                    continue
                for h, key, start, places in runs_of(text, length, gram):
                    for c, v in zip(held, (h, key, np.full(len(h), doc, np.int64), packed(tag, start, places))):
                        c.append(v)
                    size += min(len(text), PIECE)
                    if size >= COMBINE:
                        yield combined()
                        size = 0
        if held[0]:
            yield combined()

    return run


_JUDGED = pa.schema([("doc", pa.int64()), ("run", pa.int64()), ("h", pa.int64())])
_CLOSER = pa.schema([("h", pa.int64()), ("key", pa.binary()), ("doc", pa.int64()), ("run", pa.int64())])


def _changes(key: pa.Array) -> np.ndarray:
    """Where a key differs from the one before it; the first place is left open."""
    return pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, pa.Array | None]]:
    """Rows (h, key, doc, run) sorted by these -> (doc, run, None, None) of copies, and (doc,
    run, h, key) of the runs that need an order: the first document's, where several
    keys and documents meet under one h.  ``key`` is a hash of the run's bytes or the
    bytes themselves.  Kept between batches is one group's latest key and, until a
    second key and document turn up, the runs of one document."""
    last = {"h": None, "key": None, "first": None, "keys": 0, "low": None, "high": None, "row": None}
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []

    for b in batches:
        h, key, doc, run = b.column("h").to_numpy(), b.column("key"), b.column("doc").to_numpy(), b.column("run").to_numpy()
        done = run < 0
        if done.any():
            yield doc[done], -1 - run[done], None, None
            h, key, doc, run = h[~done], key.filter(pa.array(~done)), doc[~done], run[~done]
        if not len(h):
            continue
        same_key = ~_changes(key)
        again = np.concatenate(([last["row"] == (key[0].as_py(), doc[0], run[0])], (run[1:] == run[:-1]) & (doc[1:] == doc[:-1]) & same_key))
        if again.any():
            h, key, doc, run = h[~again], key.filter(pa.array(~again)), doc[~again], run[~again]
            if not len(h):
                continue
        new_h = np.concatenate(([h[0] != last["h"]], h[1:] != h[:-1]))
        new_key = new_h | np.concatenate(([key[0].as_py() != last["key"]], _changes(key)))
        at = np.flatnonzero(new_key)
        number = np.cumsum(new_key)
        first = np.concatenate(([last["first"] if last["first"] is not None else 0], doc[at]))[number]
        copy = doc > first
        if copy.any():
            yield doc[copy], run[copy], None, None
        # group by h; group 0 goes on from the batch before
        group = np.cumsum(new_h)
        n = int(group[-1]) + 1
        keys = np.bincount(group, new_key, n).astype(np.int64)
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(low, group, doc)
        np.maximum.at(high, group, doc)
        if not new_h[0]:
            keys[0] += last["keys"]
            low[0], high[0] = min(low[0], last["low"]), max(high[0], last["high"])
        meets = (keys > 1) & (low != high)
        if not new_h[0] and meets[0]:
            yield from waiting
        if new_h.any() or meets[0]:
            waiting = []
        ask = ~copy & meets[group]
        if ask.any():
            yield doc[ask], run[ask], h[ask], key.filter(pa.array(ask))
        if not meets[-1]:
            mine = ~copy & (group == n - 1)
            if mine.any():
                waiting.append((doc[mine], run[mine], h[mine], key.filter(pa.array(mine))))
        last = {"h": h[-1], "key": key[-1].as_py(), "first": first[-1], "keys": int(keys[-1]), "low": int(low[-1]), "high": int(high[-1]),
                "row": (key[-1].as_py(), doc[-1], run[-1])}


def _judge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, key, doc, run): copies (h null), and the runs that need an order."""
    for doc, run, h, _ in _meeting(batches):
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(run), pa.nulls(len(doc), pa.int64()) if h is None else pa.array(h)], schema=_JUDGED)


def _in_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Arrow batches joined to blocks of at least ``rows`` rows, but the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _places(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of runs, joined, and of each of their places: its run, where in the run, where in the joined bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    places = sizes - (length - 1)
    owner = np.repeat(np.arange(len(texts)), places)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(places) - places, places)
    return np.frombuffer(b"".join(texts), np.uint8), owner, within, (np.cumsum(sizes) - sizes)[owner] + within


def part_of(run: np.ndarray, within: np.ndarray, places: np.ndarray | int) -> np.ndarray:
    """Of packed runs the parts of ``places`` places that begin ``within`` them."""
    start = ((run >> np.int64(RUN_BITS)) & np.int64((1 << START_BITS) - 1)) + within
    return packed(run >> np.int64(START_BITS + RUN_BITS), start, np.asarray(places))


def _deal_closer(length: int, gram: int):
    """Runs with their bytes -> shorter runs with theirs, by the smallest hash of longer strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _in_blocks(batches, ORDER_ROWS):
            doc, runs = b.column("doc").to_numpy(), b.column("run").to_numpy()
            text, owner, within, at = _places(b.column("bytes").to_pylist(), length)
            least = sliding_least(gram_hashes(text, gram), length - gram + 1)[at]
            begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1]))))
            places = np.diff(begin, append=len(owner))
            own, whole = owner[begin], text.tobytes()
            key = [whole[i:j] for i, j in zip(at[begin].tolist(), (at[begin] + places + (length - 1)).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(least[begin].view(np.int64)), pa.array(key, pa.binary()), pa.array(doc[own]),
                                              pa.array(part_of(runs[own], within[begin], places))], schema=_CLOSER)

    return run


def nearest_smaller(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order the nearest place before and after it
    with a smaller document, -1 if there is none."""
    def before(d: np.ndarray) -> np.ndarray:
        near = np.arange(len(d)) - 1
        todo = np.arange(len(d))
        while len(todo):
            todo = todo[near[todo] >= 0]
            todo = todo[d[near[todo]] >= d[todo]]
            near[todo] = near[near[todo]]          # all between are no smaller
        return near

    after = before(doc[::-1])[::-1]
    return before(doc), np.where(after >= 0, len(doc) - 1 - after, -1)


def has_previous_factor(suffixes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each suffix (fixed-width bytes,
    cut at the wanted length) has that length: its nearest neighbours of a
    smaller document in suffix order are compared with it."""
    order = np.argsort(suffixes, kind="stable")
    s, d = suffixes[order], doc[order]
    out = np.zeros(len(s), bool)
    for near in nearest_smaller(d):
        out |= (near >= 0) & (s[near] == s)
    result = np.empty(len(s), bool)
    result[order] = out
    return result


_ORDERED = pa.schema([("s", pa.binary()), ("doc", pa.int64()), ("run", pa.int64())])


def _order_runs(length: int, order_rows: int):
    """Runs with their bytes, sorted by (h, bytes, doc, run): copies (s null), and of the
    places of runs that need an order those (s, doc, run) that are no copy within their block."""
    def ordered(held: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> Iterator[pa.RecordBatch]:
        doc, run = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        text, owner, within, at = _places([t for x in held for t in x[2].to_pylist()], length)
        suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[at])
        copy = has_previous_factor(suffixes.view(f"S{length}").ravel(), doc[owner])
        for rows in (copy, ~copy):
            if rows.any():
                own = owner[rows]
                strings = pa.nulls(len(own), pa.binary()) if rows is copy else pa.array(suffixes[rows].view(f"V{length}").ravel().tolist(), pa.binary())
                yield pa.RecordBatch.from_arrays([strings, pa.array(doc[own]), pa.array(part_of(run[own], within[rows], 1))], schema=_ORDERED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for doc, run, h, text in _meeting(batches):
            if h is None:
                yield pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.binary()), pa.array(doc), pa.array(run)], schema=_ORDERED)
                continue
            held.append((doc, run, text))
            size += len(doc)
            if size >= order_rows:
                yield from ordered(held)
                held, size = [], 0
        if held:
            yield from ordered(held)

    return run


def _first_of_equals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places sorted by (s, doc): those whose string stands in a smaller document.  The
    smallest document of the latest string is carried on."""
    last, least = None, 0
    for b in batches:
        s, doc, run = b.column("s"), b.column("doc").to_numpy(), b.column("run").to_numpy()
        if not len(doc):
            continue
        new = np.concatenate(([s[0].as_py() != last], _changes(s)))
        first = np.concatenate(([least], doc[new]))[np.cumsum(new)]
        copy = doc > first
        if copy.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[copy]), pa.array(run[copy])], names=["doc", "run"])
        last, least = s[-1].as_py(), int(first[-1])


def copies(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, order_rows: int = ORDER_ROWS) -> DataFrame:
    """(doc, run): the runs of later copies in ``docs`` (doc long, tag long,
    text binary); see ``packed``.  Together they name every place whose longest
    previous factor has ``length`` bytes."""
    if not 1 <= gram <= length:
        raise ValueError("the hashed strings must fit in the wanted length")
    found = docs.mapInArrow(_find_runs(length, gram), T._parse_datatype_string("h long, key long, doc long, run long"))
    judged = written(found.repartition("h").sortWithinPartitions("h", "key", "doc", "run")
                     .mapInArrow(_judge_runs, "doc long, run long, h long"), "lpf-runs")
    f = _runs_sql()
    asked = judged.filter("h IS NOT NULL").withColumn("tag", F.expr(f["tag"]))
    with_bytes = asked.join(docs, ["doc", "tag"]).select("doc", "run", F.expr(
        f"substring(text, CAST({f['start']} AS INT) + 1, CAST({f['places']} AS INT) + {length - 1})").alias("bytes"))
    closer = with_bytes.mapInArrow(_deal_closer(length, max(gram, length - CLOSER)), "h long, key binary, doc long, run long")
    ordered = written(closer.repartition("h").sortWithinPartitions("h", "key", "doc", "run")
                      .mapInArrow(_order_runs(length, order_rows), "s binary, doc long, run long"), "lpf-order")
    rest = (ordered.filter("s IS NOT NULL").repartition("s").sortWithinPartitions("s", "doc")
            .mapInArrow(_first_of_equals, "doc long, run long"))
    return judged.filter("h IS NULL").select("doc", "run").union(ordered.filter("s IS NULL").select("doc", "run")).union(rest)


def merged(runs: list[int], length: int) -> list[tuple[int, int]]:
    """Byte spans (start, end) that the runs cover, joined where they touch or overlap, in order."""
    out: list[tuple[int, int]] = []
    r = np.array(runs, np.int64)
    start = (r >> np.int64(RUN_BITS)) & np.int64((1 << START_BITS) - 1)
    end = start + (r & np.int64(RUN - 1)) + length
    for a, b in sorted(zip(start.tolist(), end.tolist())):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                  order_rows: int = ORDER_ROWS, spans_col: str = "spans", kept_col: str = "kept", as_text: bool = False) -> DataFrame:
    """``docs`` with two columns more: ``spans`` array<struct<start, end>>, the
    maximal byte runs of the whole text that are covered by ``length``-byte
    strings which also start in a document of a smaller id, and ``kept`` binary,
    the remaining bytes (``as_text``: a string, without characters that lost some of their bytes).

    Strings are judged on the input, matches never cross documents, overlaps
    count.  Null and empty texts, and texts shorter than ``length`` bytes, have
    no spans.  Rows of one id never remove each other; each keeps its own spans
    (rows of one id with different texts are told apart by a 22-bit hash of the
    text).  A null id counts as larger than any other.  All columns are kept;
    ``spans_col`` and ``kept_col`` must not be among them.  An empty table gives
    an empty result.

    The texts are scanned once for their runs (about one row of four numbers for
    17 bytes, copies within a task combined before the shuffle), and joined
    twice by id: to fetch the runs that need an order, and to cut the copies.
    The runs that collapse first are equal by two 64-bit hashes, one of them of all
    their bytes; everything after that compares the bytes themselves.
    """
    taken = {c.lower() for c in docs.columns}
    if {spans_col.lower(), kept_col.lower()} & taken:
        raise ValueError(f"documents already have a column {spans_col} or {kept_col}")

    doc, tag, runs, cut_col = (fresh(docs, c) for c in ("lpf_doc", "lpf_tag", "lpf_runs", "lpf_cut"))
    keyed = (docs.withColumn(doc, F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)))
             .withColumn(tag, F.xxhash64(utf8(text_col)).bitwiseAND(F.lit((1 << TAG_BITS) - 1))))
    found = copies(keyed.select(F.col(doc).alias("doc"), F.col(tag).alias("tag"), utf8(text_col).alias("text")), length, gram, order_rows)
    by_row = (found.groupBy(F.col("doc").alias(doc), F.expr(_runs_sql()["tag"]).alias(tag))
              .agg(F.collect_set("run").alias(runs)))

    kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string() if as_text else pa.binary())])

    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(texts.to_pylist(), lists.to_pylist()):
            spans = merged(r, length) if r else []
            ends = [0, *(e for _, e in spans)]
            starts = [*(s for s, _ in spans), len(t)]
            kept = b"".join([t[a:b] for a, b in zip(ends, starts)])
            out.append({"spans": [{"start": a, "end": b} for a, b in spans],
                        "kept": kept.decode("utf-8", "ignore") if as_text else kept})
        return pa.array(out, type=kind)

    cut.__annotations__ = {"texts": pa.Array, "lists": pa.Array, "return": pa.Array}
    cutter = F.arrow_udf(cut, f"spans array<struct<start:long,end:long>>, kept {'string' if as_text else 'binary'}").asNondeterministic()
    return (keyed.join(by_row, [doc, tag], "left")
            .withColumn(cut_col, cutter(utf8(text_col), F.col(runs)))
            .select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{cut_col}.spans").alias(spans_col), F.col(f"{cut_col}.kept").alias(kept_col)))
