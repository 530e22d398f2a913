"""Operator 11 against all edits of short conversations, and long ones cut into runs."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import dialogue as D
from strata.llm.common import prepare

from .helpers import bag

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def _settings(spark):
    prepare(spark)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def legal(roles):
    s = "".join(r[:1] for r in roles)
    if any(r[:1] not in "sua" or not r for r in roles):
        return False
    s = s[1:] if s.startswith("s") else s
    return s == "ua" * (len(s) // 2) and not (len(roles) == 1)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        core = text.strip(D.BLANKS)
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows, all_ids):
    """Every edit sequence: each row kept, re-roled or deleted, at most two inserts between."""
    out = []
    for conv in all_ids:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        marks = faults(own)
        best = None
        edits = [["D"] if m in ("blank", "duplicate") else ["D", "K", "Ruser", "Rassistant"] for m in marks]
        inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
        for chosen in itertools.product(*edits):
            for places in itertools.product(inserts, repeat=len(own) + 1):
                if sum(map(len, places)) > 2:
                    continue
                cost, audit, lines = 0, "", []
                for i in range(len(own) + 1):
                    for role in places[i]:
                        cost, audit = cost + 5, audit + "I"
                        lines.append((role, ""))
                    if i < len(own):
                        e = chosen[i]
                        audit += e[0]
                        if e == "D":
                            cost += 2
                        else:
                            cost += (e[0] == "R") + 5 * (marks[i] == "truncated")
                            lines.append((e[1:] or own[i][2], own[i][3]))
                if (best is None or (cost, audit) < best[:2]) and (not lines or legal([r for r, _ in lines])):
                    best = cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), best[0], best[1],
                    hashlib.sha256(best[2].encode()).hexdigest()))
    return out


def odd(seed, conversations=25):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, 4)):
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), rng.choice(["user", "assistant", "system", "tool", "", None, "sys", "User"]),
                         rng.choice(["One.", "Two!", "Three? ", "four", "é.", "", " \n\t", None, " ", "One.", "."])))
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_edit(spark, seed):
    rows = odd(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("copies", F.lit("x")).withColumn("part", F.lit(1))
    made = D.repair(D.damaged(df))
    assert made.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert bag(made.collect()) == bag(brute(plain_damage(rows), list({r[0]: 0 for r in rows})))


def test_undamaged_and_empty(spark):
    rows = odd(3, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    fill = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert bag(D.repair(D.undamaged(df)).collect()) == bag(brute(fill, list({r[0]: 0 for r in rows})))
    assert D.repair(D.damaged(df.limit(0))).collect() == []


def long_rows(kind, n):
    rng = random.Random(n)
    role = {"alternating": lambda i: "assistant" if i % 2 else "user", "off by one": lambda i: "user" if i % 2 else "assistant",
            "one role": lambda i: "user", "any": lambda i: rng.choice(["user", "assistant", "system", "tool"])}
    text = {"truncated": lambda i: f"text {i}", "copies": lambda i: "Same."}
    return [(7, i if kind != "no turn" else None, role.get(kind, role["any"])(i), text.get(kind, lambda i: f"Text {i}." if rng.random() < .8 else f"cut {i}")(i))
            for i in range(n)]


@pytest.mark.parametrize("kind", ["alternating", "off by one", "one role", "any", "truncated", "copies", "no turn"])
def test_a_conversation_over_many_partitions(spark, kind, monkeypatch):
    rows = long_rows(kind, 700) + [(6, i, "user", f"Q{i}.") for i in range(5)] + [(8, 0, "user", "Q?"), (8, 1, "assistant", "A.")]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: r for r in D.repair(D.damaged(df.repartition(3))).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    kept = plain_damage(rows)
    for conv in (6, 7, 8):
        run = D.Run()
        seen = set()
        for _, turn, role, text in sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
            run.add(turn, role, text, 1, (role, text) in seen)
            seen.add((role, text))
        back = D.backward(bytes(run.codes))
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        edits, _ = D.trace(bytes(run.codes), back, D.START, True)
        body = "\n".join(D.repaired(edits, D.START, iter([(r, t, 1) for _, _, r, t in own])))
        assert tuple(got[conv])[1:] == (D.gaps(run.low, run.high, run.turns), *run.counts.values(), back[0][0], edits, hashlib.sha256(body.encode()).hexdigest())


def test_fix_up_stops_where_vectors_run_parallel():
    rng = random.Random(4)
    for _ in range(200):
        codes = bytes(rng.randrange(9) for _ in range(rng.randint(0, 40)))
        old, new = (tuple(rng.randint(0, 12) for _ in range(4)) for _ in range(2))
        start = D.start_of(codes, old)
        assert start == D.backward(codes, old)[0]
        assert D.start_of(codes, new, (old, start)) == D.backward(codes, new)[0]
