"""Operator 11: conversation structure repair by a rank-convergence parallel Viterbi search.

A conversation should read ``(s?(ua)+)?`` in role initials.  Its cheapest repair is
a shortest path through four states (nothing yet, after system, after user, after
assistant); ``back[i]`` holds the cost from row i to the end out of each state.

Rows are range-partitioned in order, so a conversation that fits between two
borders is solved where it lies, and a long one is cut into runs, one a
partition.  All runs start at once from a speculative cost vector, the one of a
conversation's end.  Fix-up passes give each run the vector that the run after it
came to, and step old and new side by side until they differ only by a
constant, from where on the old decisions hold.  When no run changes, the vectors
are stitched with their constants, each run is traced from the state in which
the one before it leaves off, and the least edit on a cheapest path is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows and characters of a run handed on together, and characters from which on a conversation is handed on in pieces.
PIECE_ROWS, PIECE_CHARS, LONG_CHARS = 2_000, 4 << 20, 32 << 20

BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant turn that is legal in each state, and that turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What the end of a conversation costs: one may end at once or after an assistant.
END = (0, 2 * INSERT, INSERT, 0)
#: A row's code: 0 must go; else 1 + 2 * initial (s, u, a, other), one more when truncated.
GONE = 0
_INITIAL = {"s": 0, "u": 1, "a": 2}
_KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})

Vector = tuple[int, int, int, int]


def _moves(code: int) -> list[tuple[tuple[str, int, int], ...]]:
    """For each state the edits of a row with this code: (letter, cost, next state), letters in order."""
    if code == GONE:
        return [(("D", DELETE, s),) for s in range(4)]
    kept, extra = _KEPT[(code - 1) // 2], TRUNCATED if (code - 1) % 2 else 0
    return [(("D", DELETE, s), *([("K", extra, kept[s])] if s in kept else []), ("R", REROLE + extra, NEXT[s])) for s in range(4)]


MOVES = [_moves(code) for code in range(9)]
#: The same without letters, and each state's cheapest way with inserts ahead of the row.
_STEPS = [[[(cost, to) for _, cost, to in ways] for ways in row] for row in MOVES]


def step(code: int, v: Vector) -> Vector:
    """The cost vector ahead of a row from the one behind it."""
    if code == GONE:
        return v[0] + DELETE, v[1] + DELETE, v[2] + DELETE, v[3] + DELETE
    a, b, c, d = (min([cost + v[to] for cost, to in ways]) for ways in _STEPS[code])
    u, t = min(c, d + INSERT), min(d, c + INSERT)
    return min(a, u + INSERT), min(b, u + INSERT), u, t


def apart(a: Vector, b: Vector) -> int | None:
    """The constant by which b lies above a, None if there is none."""
    d = b[0] - a[0]
    return d if b[1] - a[1] == d and b[2] - a[2] == d and b[3] - a[3] == d else None


def backward(codes: bytes, end: Vector = END) -> list[Vector]:
    """The cost vectors ahead of every row and behind the last."""
    out = [end]
    for code in reversed(codes):
        out.append(step(code, out[-1]))
    out.reverse()
    return out


def start_of(codes: bytes, end: Vector, old: tuple[Vector, Vector] | None = None) -> Vector:
    """The cost vector ahead of a run.  ``old`` is an end vector used before and the
    start it led to: once both differ only by a constant, the old start holds."""
    v, w = end, old[0] if old else None
    for code in reversed(codes):
        if w is not None:
            if (d := apart(w, v)) is not None:
                return tuple(x + d for x in old[1])
            w = step(code, w)
        v = step(code, v)
    return v


def trace(codes: bytes, back: list[Vector], state: int, last: bool) -> tuple[str, int]:
    """(edits, state behind the run): from ``state`` along a cheapest path, the least
    letter first.  Inserts at a run's end belong to the run after it, if there is one."""
    edits, i = [], 0
    while i < len(codes) or (last and back[i][state]):
        now = back[i][state]
        ways = MOVES[codes[i]][state] if i < len(codes) else ()
        if ways and DELETE + back[i + 1][state] == now:
            edits.append("D")
            i += 1
        elif INSERT + back[i][NEXT[state]] == now:
            edits.append("I")
            state = NEXT[state]
        else:
            letter, state = next((c, to) for c, cost, to in ways if cost + back[i + 1][to] == now)
            edits.append(letter)
            i += 1
    return "".join(edits), state


def repaired(edits: str, state: int, rows: Iterator[tuple[str, str, int]]) -> Iterator[str]:
    """The repaired rows as ``role:text``, from the edits and the rows (role, text, copies)."""
    place = 0

    def inserts() -> Iterator[str]:
        nonlocal state, place
        while place < len(edits) and edits[place] == "I":
            state, place = NEXT[state], place + 1
            yield f"{ROLE[state]}:"

    for role, text, copies in rows:
        for _ in range(copies):
            yield from inserts()
            edit, place = edits[place], place + 1
            if edit == "K":
                state = _KEPT[_INITIAL[role[0]]][state]
                yield f"{role}:{text}"
            elif edit == "R":
                state = NEXT[state]
                yield f"{ROLE[state]}:{text}"
    yield from inserts()


# ---- rows of a conversation --------------------------------------------------------
class Run:
    """The rows of one conversation within one partition: codes, counts and, piece by piece, the texts."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self) -> None:
        self.codes = bytearray()
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.low = self.high = self.first = self.last = None            # turns; initials of the first and last row
        self.turns = 0
        self.rows: list[tuple[str, str, int]] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, later: bool) -> None:
        """``copies`` equal rows; ``later``: their role and text stand earlier too."""
        if not copies:
            return
        core = text.strip(BLANKS)
        initial, code = role[:1], GONE
        if not core:
            self.counts["blank"] += copies
        elif later:
            self.counts["duplicate"] += copies
        else:
            cut = core[-1] not in ".!?"
            code = 1 + 2 * _INITIAL.get(initial, 3) + cut
            self.counts["truncated"] += cut
            self.counts["duplicate"] += copies - 1
        self.codes += bytes([code]) + bytes(copies - 1)
        if self.last is not None:
            self.counts["illegal"] += illegal(self.last, initial)
        else:
            self.first = initial
        self.counts["illegal"] += (copies - 1) * illegal(initial, initial)
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn
        if code == GONE:
            text = ""                                                    # it goes, whatever it says
        self.rows.append((role, text, copies))
        self.chars += len(role) + len(text)


def illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_STATS = "low long, high long, turns long, first string, last string"
_KINDS = "kind string, part int, seq int, codes binary, roles array<string>, texts array<string>, copies array<long>"


def _names(*schemas: str) -> list[str]:
    return [f.split()[0] for s in schemas for f in s.split(", ")]


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
          "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[dict], *schemas: str) -> pa.RecordBatch:
    fields = [f.split() for s in schemas for f in s.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _ARROW[t]) for n, t in fields], names=[n for n, _ in fields])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order -> whole conversations solved; the first and the last
    of the partition, which may reach over its borders, as runs: codes and counts
    (kind ``run``) and texts in pieces (kind ``piece``)."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    run, conv, seq = None, None, 0
    apart = True                  # the run goes on in pieces: the partition's first, or a long one
    out: list[dict] = []
    size = 0

    def piece() -> dict:
        nonlocal seq
        roles, texts, copies = map(list, zip(*run.rows))
        run.rows, run.chars, seq = [], 0, seq + 1
        return {"kind": "piece", "conv_id": conv, "part": part, "seq": seq, "roles": roles, "texts": texts, "copies": copies}

    def closed() -> dict:
        back = backward(run.codes)
        edits, _ = trace(run.codes, back, START, True)
        text = "\n".join(repaired(edits, START, run.rows))
        return {"kind": "whole", "conv_id": conv, "gaps": gaps(run.low, run.high, run.turns), **run.counts, "cost": back[0][START],
                "audit": edits, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}

    def opened() -> list[dict]:
        return [*([piece()] if run.rows else []),
                {"kind": "run", "conv_id": conv, "part": part, "seq": 0, "codes": bytes(run.codes), **run.counts,
                 **{n: getattr(run, n) for n in _names(_STATS)}}]

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal out, size
        if out:
            yield _batch(out, _KINDS, _RESULT, _STATS)
        out, size = [], 0

    for b in batches:
        for c, turn, role, text, copies, later in zip(*(b.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "copies", "later"))):
            if run is None or c != conv:
                if run is not None:
                    out += opened() if apart else [closed()]
                    apart = False
                run, conv, seq = Run(), c, 0
            run.add(turn, role, text, copies, later)
            size += len(text)
            apart = apart or run.chars > LONG_CHARS
            if apart and run.rows and (run.chars > PIECE_CHARS or len(run.rows) >= PIECE_ROWS):
                out.append(piece())
            if size > PIECE_CHARS or len(out) >= PIECE_ROWS:
                yield from flush()
    if run is not None:
        out += opened()
    yield from flush()


# ---- Spark steps ------------------------------------------------------------------
def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): every row after its damage, by crc32
    of ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops it, 1 empties the text, 2 takes
    its ``.!?`` out, 3 repeats it, 4 makes the role ``user``.  A dropped row leaves a
    mark without copies, so that its conversation is not forgotten."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(own(conv_col), F.lit(":"), own(turn_col))) % 20
    gone = fault == 0
    text = F.when(fault == 1, "").when(fault == 2, F.translate(own(text_col), ".!?", "")).otherwise(own(text_col))
    return rows.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.when(~gone, F.col(turn_col).cast("long")).alias("turn"),
        F.when(gone, "").when(fault == 4, "user").otherwise(own(role_col)).alias("role"), F.when(gone, "").otherwise(text).alias("text"),
        F.when(gone, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


def undamaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of a conversation table as they are; null roles and texts read as one space."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       own(role_col).alias("role"), own(text_col).alias("text"), F.lit(1).cast("long").alias("copies"))


def _flagged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with a count, and whether role and text stand on an earlier
    turn of the conversation.  A hash finds the few that stand twice, the strings decide."""
    once = written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "dialogue-rows", free=False)
    hashed = once.filter("copies > 0").withColumn("h", F.xxhash64("conv_id", "role", "text"))
    twice = hashed.groupBy("h").count().filter("count > 1").select("h")
    first = (hashed.join(twice, "h", "left_semi").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"))
             .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("no_turn")))
    later: Column = F.when(F.col("no_turn"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least"))
    return (once.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t")), "left")
            .select("conv_id", "turn", "role", "text", "copies", F.coalesce(later, F.lit(False)).alias("later")))


def _fix_up(shared):
    """The start vector of every run that was handed a new end vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, part, codes in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "codes"))):
                if (conv, part) in shared.value:
                    end, old = shared.value[conv, part]
                    out.append({"conv_id": conv, "part": part, "vector": list(start_of(codes, end, old))})
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r["conv_id"] for r in out], pa.int64()), pa.array([r["part"] for r in out], pa.int32()),
                                                  pa.array([r["vector"] for r in out], pa.list_(pa.int64()))], names=["conv_id", "part", "vector"])

    return run


def _exits(shared):
    """The state in which each run leaves off, for each state it may start from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(conv, part, [trace(codes, back, s, False)[1] for s in range(4)])
                    for conv, part, codes in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "codes")))
                    for back in [backward(codes, shared.value[conv, part])]]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.list_(pa.int64())))],
                                             names=["conv_id", "part", "vector"])

    return run


def _edits(shared):
    """Each run's edits, ahead of its pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, part, codes in zip(*(b.column(c).to_pylist() for c in ("conv_id", "part", "codes"))):
                end, state, last, _ = shared.value[conv, part]
                out.append({"conv_id": conv, "part": part, "seq": 0, "audit": trace(codes, backward(codes, end), state, last)[0]})
            yield _batch(out, _TRACED)

    return run


_TRACED = "conv_id long, part int, seq int, audit string, roles array<string>, texts array<string>, copies array<long>"
_TEXTS = "conv_id long, part int, seq int, audit string, body string"


def _bodies(shared):
    """Rows sorted by (conv_id, part, seq), a run's edits first: the edits and the
    repaired text of each piece.  A piece without repaired rows has a null body."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, place, state = "", 0, START
        for b in batches:
            for conv, part, seq, audit, roles, texts, copies in zip(*(b.column(n).to_pylist() for n in _names(_TRACED))):
                if not seq:
                    edits, place, state = audit, 0, shared.value[conv, part][1]
                    more = len(edits) - len(edits.rstrip("I")) if shared.value[conv, part][2] else 0
                    rest = len(edits) - more                       # inserts behind the last row, if it is the conversation's
                    tail, s = [], shared.value[conv, part][3]
                    for _ in range(more):
                        s = NEXT[s]
                        tail.append(f"{ROLE[s]}:")
                    edits, closing = edits[:rest], edits[rest:]
                    # the closing inserts go behind every piece
                    yield _batch([{"conv_id": conv, "part": part, "seq": 2**31 - 1, "audit": closing, "body": "\n".join(tail) if tail else None}], _TEXTS)
                    continue
                n, at = sum(copies), place
                while n:                                           # the edits of this piece: one a row, and the inserts ahead of it
                    n -= edits[at] != "I"
                    at += 1
                mine, place = edits[place:at], at
                made = list(repaired(mine, state, zip(roles, texts, copies)))
                for e, code in _replayed(mine, roles, copies):
                    state = NEXT[state] if e in "IR" else _KEPT[code][state] if e == "K" else state
                yield _batch([{"conv_id": conv, "part": part, "seq": seq, "audit": mine, "body": "\n".join(made) if made else None}], _TEXTS)

    return run


def _replayed(edits: str, roles: list[str], copies: list[int]) -> Iterator[tuple[str, int]]:
    """Each edit with the initial of the row it is on (3 for an insert)."""
    initials = (_INITIAL.get(r[:1], 3) for r, n in zip(roles, copies) for _ in range(n))
    for e in edits:
        yield e, 3 if e == "I" else next(initials)


def _joined(shared):
    """Pieces sorted by (conv_id, part, seq) -> one row a conversation; the texts stream through the hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, audit, begun = None, None, [], False

        def result() -> pa.RecordBatch:
            return _batch([{"conv_id": conv, **shared.value[conv], "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], _RESULT)

        for b in batches:
            for c, part, seq, edits, body in zip(*(b.column(n).to_pylist() for n in _names(_TEXTS))):
                if sha is None or c != conv:
                    if sha is not None:
                        yield result()
                    conv, sha, audit, begun = c, hashlib.sha256(), [], False
                audit.append(edits)
                if body is not None:
                    sha.update(("\n" if begun else "").encode() + body.encode())
                    begun = True
        if sha is not None:
            yield result()

    return run


def _stitch(runs: DataFrame) -> tuple[dict, dict]:
    """({(conv, part): (end vector, start state, last, state behind)}, {conv: counts})
    of the runs that may reach over a border.  The driver holds two runs a partition at most."""
    spark = runs.sparkSession
    codes = runs.select("conv_id", "part", "codes")
    rows = runs.select("conv_id", "part", *Run.COUNTS, *_names(_STATS)).collect()
    order: dict = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        order.setdefault(r["conv_id"], []).append(r)
    ends: dict = {(c, r["part"]): END for c, rs in order.items() for r in rs}
    starts: dict = {}
    todo = {key: (END, None) for key in ends}                            # the speculative start
    while todo:
        shared = spark.sparkContext.broadcast(todo)
        starts.update({(r["conv_id"], r["part"]): tuple(r["vector"]) for r in codes.mapInArrow(_fix_up(shared), _PASS).collect()})
        shared.destroy()
        todo = {}
        for c, rs in order.items():
            behind = END
            for r in reversed(rs):
                key = c, r["part"]
                if (d := apart(ends[key], behind)) is None:
                    todo[key] = behind, (ends[key], starts[key])
                    ends[key] = behind
                elif d:
                    ends[key], starts[key] = behind, tuple(x + d for x in starts[key])
                behind = starts[key]
    shared = spark.sparkContext.broadcast(ends)
    exits = {(r["conv_id"], r["part"]): r["vector"] for r in codes.mapInArrow(_exits(shared), _PASS).collect()}
    shared.destroy()
    plan, results = {}, {}
    for c, rs in order.items():
        state = START
        low = high = last = None
        total = dict.fromkeys(Run.COUNTS, 0)
        turns = 0
        for i, r in enumerate(rs):
            leaves = exits[c, r["part"]][state]
            plan[c, r["part"]] = ends[c, r["part"]], state, i == len(rs) - 1, leaves
            state = leaves
            for n in Run.COUNTS:
                total[n] += r[n]
            if r["first"] is not None:
                total["illegal"] += last is not None and illegal(last, r["first"])
                last = r["last"]
            if r["low"] is not None:
                turns += r["turns"] - (high == r["low"])
                low, high = (r["low"] if low is None else low), r["high"]
        results[c] = {"gaps": gaps(low, high, turns), **total, "cost": starts[c, rs[0]["part"]][START]}
    return plan, results


_PASS = "conv_id long, part int, vector array<long>"


def repair(rows: DataFrame) -> DataFrame:
    """One row for each conversation of ``rows`` (conv_id long, turn long, role,
    text, copies long; see ``damaged`` and ``undamaged``): conv_id, gaps in the turn numbers, rows by first fault
    (blank, duplicate, truncated), illegal neighbours, the least cost of a repair, its
    edits (K keep, R rerole, D delete, I insert; of the cheapest the least
    string) and the sha256 of the repaired ``role:text`` lines.

    Rows go by turn, null first, equal turns by role and text.  A null conversation
    id is a conversation of its own.  Repeated rows are duplicates.  A conversation without
    rows has zeros, no edits and the empty string's hash.  An empty table gives
    an empty result; extra columns are not read.

    A conversation of any length is spread over partitions; only its codes, a byte
    a row, are held by a task, and only its runs' vectors by the driver.  The
    hash of one conversation is a single stream by its nature, and so is its audit.
    """
    order = ("conv_id", "turn", "role", "text")
    made = written(_flagged(rows).repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_runs, f"{_KINDS}, {_RESULT}, {_STATS}"), "dialogue-runs", free=False)
    whole = made.filter("kind = 'whole'").select(*_names(_RESULT))
    runs = made.filter("kind = 'run'")
    plan, results = _stitch(runs)
    if not plan:
        return whole
    sc = rows.sparkSession.sparkContext
    plan, results = sc.broadcast(plan), sc.broadcast(results)
    pieces = made.filter("kind = 'piece'").select("conv_id", "part", "seq", F.lit(None).cast("string").alias("audit"), "roles", "texts", "copies")
    traced = runs.select("conv_id", "part", "codes").mapInArrow(_edits(plan), _TRACED)
    bodies = (traced.union(pieces).repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_bodies(plan), _TEXTS))
    joined = bodies.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(_joined(results), _RESULT)
    return whole.union(joined)
