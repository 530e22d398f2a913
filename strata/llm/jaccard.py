"""Operator 12: n-gram Jaccard join by partitions of the universe.

Two sets of sizes s <= l with Jaccard similarity p % or more differ in at most
H = (s + l) * (100 - p) / (100 + p) shingles.  Sizes fall into bands, and each
band cuts the universe of shingles into segments by a hash.  A set of the band is
listed under the subset it has in every segment, and in a few reserve segments
under its one-deletion neighbourhood too: the subset without each one of its
shingles.  The larger set of a pair allots a radius to each segment: -1 (not asked),
0 (equal subsets) or 1 (subsets that differ in one shingle).  When radius + 1 adds
up to H + 1 or more, some segment must find the pair.  The cost of a radius is the
company its keys have, counted over all sets, and the cheapest allotment is taken.  A set
that can allot H + 1 without company has no partner; a subset that many unrelated
sets share, or an empty one, is asked only by a set that has no other way.

Sets that meet under an asked key are candidates for a growing number of leaders of the
key; sets already connected are not compared again, so a key of n near copies costs n
comparisons and not n squared.  A set carries the parity of its shingles in each of some
hundred bins.  Every shingle that only one of two sets has turns one bin, so sets whose
parities differ in more than H bins can't be linked and never become a pair.  The
others are compared shingle by shingle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8, written
from .components import components

SHINGLE = 5
PERCENT = 80
#: One segment in so many (and one more) also lists one-deletion neighbourhoods.
RESERVE = 16
#: Company is counted up to here; keys with more cost the same.
COMPANY = 256
#: Leaders of a key in the first round of comparisons, and by how much they grow.
LEADERS, GROWTH = 1, 32
#: Bins of a set's parities: between these, and two to four for each shingle.
BINS = 256, 8192
#: Comparisons with one set that one task makes; more are dealt over several tasks.
DEAL = 500

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9))


def words(text: bytes) -> list[bytes]:
    """A-Z lower-cased, words between ASCII white space."""
    return _WORD.findall(text.translate(_LOWER))


def shingles(text: bytes, k: int = SHINGLE) -> set[bytes]:
    """The distinct ``k``-word shingles; a text of fewer words is one, a text without words has none."""
    w = words(text)
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * by
    return (x ^ (x >> np.uint64(29))) * _C


def shingle_hashes(text: bytes, k: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the distinct shingles, in order."""
    w = words(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - k + 1)
    out = np.full(n, len(w) if len(w) < k else k, np.uint64)
    for i in range(min(k, len(w))):
        out = mixed(out + h[i:i + n], _A)
    return np.unique(out)


# ---- bands and bounds ---------------------------------------------------------
def most_apart(s: int, l: int, percent: int) -> int:
    """The most shingles that linked sets of sizes ``s`` and ``l`` can differ in."""
    return (s + l) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def band(number: int, percent: int) -> tuple[int, int]:
    """Smallest and largest size of a band; a linked pair lies in one band or in two adjoining ones."""
    low = 1 if number == 0 else band(number - 1, percent)[1] + 1
    return low, low * 100 // percent


def band_of(n: int, percent: int) -> int:
    number = 0
    while band(number, percent)[1] < n:
        number += 1
    return number


@lru_cache(maxsize=None)
def segments(number: int, percent: int) -> int:
    high = band(number, percent)[1]
    return most_apart(high, high * 100 // percent, percent) + 1


def units(n: int, number: int, percent: int) -> tuple[int, int, int]:
    """(segments, reserve segments, radius + 1 to allot) of a set of size ``n`` that asks in a band, its own or the one below."""
    m = segments(number, percent)
    return m, min(m, m // RESERVE + 1), most_apart(min(n, band(number, percent)[1]), n, percent) + 1


def asked_bands(n: int, percent: int) -> list[int]:
    """The bands in which a set may have a smaller partner: its own first."""
    own = band_of(n, percent)
    return [own, own - 1] if own and n * percent <= 100 * band(own - 1, percent)[1] else [own]


#: What an entry is: the set's own subset listed, a neighbour of it listed, its own subset asked, a neighbour asked.
LISTED, NEAR, ASKS, WIDE = 1, 2, 4, 8


def entries(hashes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, kind, unit) of one set: where it is listed, and where it can ask as the larger of a
    pair.  ``unit`` is 2 * segment, one more in the band below its own."""
    n = len(hashes)
    keys, kinds, places = [], [], []
    for below, number in enumerate(asked_bands(n, percent)):
        m, reserve, _ = units(n, number, percent)
        seed = np.uint64(number * 0x9E3779B97F4A7C15 & (2**64 - 1))
        part = ((mixed(hashes + seed, _B) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        value = mixed(hashes, _A)
        total = np.zeros(m, np.uint64)
        np.add.at(total, part, value)
        place = seed + (np.arange(m, dtype=np.uint64) + np.uint64(1)) * _B
        near = part < reserve                      # subsets without one shingle
        p = part[near]
        keys += [mixed(total + place, _C), mixed(total[p] - value[near] + place[p], _C)]
        kinds += [np.full(m, ASKS if below else LISTED | ASKS), np.full(len(p), WIDE if below else NEAR | WIDE)]
        places += [2 * np.arange(m) + below, 2 * p + below]
    return np.concatenate(keys).view(np.int64), np.concatenate(kinds), np.concatenate(places)


def allotment(n: int, percent: int, costs: dict[tuple[int, int], int]) -> set[tuple[int, int]]:
    """The (unit, radius) with company that a set of size ``n`` must ask, by their
    ``costs`` (those left out have none): in each band the cheapest that make up H + 1."""
    chosen = set()
    for below, number in enumerate(asked_bands(n, percent)):
        m, reserve, need = units(n, number, percent)
        own = {(u, r): c for (u, r), c in costs.items() if u % 2 == below and (r == 0 or u // 2 < reserve)}
        for u, r in list(own):                     # a radius of 1 comes after one of 0
            if r == 0 and u // 2 < reserve:
                own[u, 1] = max(own[u, 0], own.get((u, 1), 0))
        chosen.update(sorted(own, key=lambda x: (own[x], x[1], x[0]))[:max(0, need - (m + reserve - len(own)))])
    return chosen


# ---- parities -----------------------------------------------------------------
def bins(n: int) -> int:
    """How many bins a set of size ``n`` has, a power of two."""
    return min(max(BINS[0], 2 << n.bit_length()), BINS[1])


def parities(hashes: np.ndarray) -> bytes:
    """Whether each bin holds an odd number of the set's shingles, one bit each."""
    w = bins(len(hashes))
    place = (mixed(hashes, _C) >> np.uint64(20)) & np.uint64(w - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=w) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(parity: int, wide: int, narrow: int) -> int:
    """Parities of ``wide`` bins as the same set has them in ``narrow`` ones."""
    while wide > narrow:
        wide //= 2
        parity = (parity >> wide) ^ (parity & (1 << wide) - 1)
    return parity


def too_far(n: int, own: int, m: int, other: int, percent: int) -> bool:
    """True when sets of these sizes and parities can't be linked."""
    if min(n, m) * 100 < max(n, m) * percent:
        return True
    w, v = bins(n), bins(m)
    if w != v:
        own, other = folded(own, w, min(w, v)), folded(other, v, min(w, v))
    return (own ^ other).bit_count() > most_apart(n, m, percent)


# ---- Spark steps ------------------------------------------------------------------
_SETS = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("parity", pa.binary())])


def _summaries(k: int):
    """Size, 128 bits and parities of each row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, h1, h2, parity = [], [], [], []
            for text in b.column(1).to_pylist():
                h = shingle_hashes(text, k)
                n.append(len(h))
                h1.append(int(mixed(h, _B).sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(mixed(h + _A, _C).sum(dtype=np.uint64).view(np.int64)))
                parity.append(parities(h))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (n, h1, h2)), pa.array(parity, pa.binary())], schema=_SETS)

    return run


#: ``size`` holds the set's size in its low 32 bits and 31 bits of its hash, which tell the texts of one id apart.
_ENTRIES = pa.schema([("key", pa.int64()), ("kind", pa.int32()), ("unit", pa.int32()), ("id", pa.int64()), ("size", pa.int64())])
_MET = pa.schema([*_ENTRIES, ("company", pa.int32()), ("wider", pa.int32())])


def _listing(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = shingle_hashes(text, k)
                if not len(h):
                    continue
                size = len(h) | int(mixed(h, _B).sum(dtype=np.uint64)) >> 33 << 32
                key, kind, unit = entries(h, percent)
                for c, v in zip(out, (key, kind.astype(np.int32), unit.astype(np.int32), np.full(len(key), doc), np.full(len(key), size))):
                    c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=_ENTRIES)

    return run


def _company(most: int):
    """Rows sorted by key -> those of keys with an asker in company.  ``company`` counts
    the other sets an own subset or a neighbour equals, ``wider`` the neighbours
    that an own subset equals too.  A key of more than ``most`` rows is passed on as it comes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = None, None

        def counted(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, kind = cols[0], cols[1]
            if not len(key):
                return
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            rows = np.diff(begin, append=len(key))
            own, near = (np.repeat(np.add.reduceat((kind & bit > 0).astype(np.int64), begin), rows) for bit in (LISTED, NEAR))
            large = np.repeat(rows > most, rows) | (key == hot if hot is not None else False)
            own, near = (np.where(large, most, np.minimum(x, most)) for x in (own, near))
            asks = kind & ASKS > 0
            company = np.where(asks, own - (kind & LISTED > 0), np.where(kind & WIDE > 0, own, 0))
            wider = np.where(asks, near, 0)
            some = large | np.repeat(np.add.reduceat(((company > 0) | (wider > 0)).astype(np.int64), begin) > 0, rows)
            if some.any():
                yield pa.RecordBatch.from_arrays([*(pa.array(c[some]) for c in cols), pa.array(company[some].astype(np.int32)),
                                                  pa.array(wider[some].astype(np.int32))], schema=_MET)

        for b in batches:
            cols = [b.column(c).to_numpy() for c in _ENTRIES.names]
            if held is not None:
                cols = [np.concatenate((h, c)) for h, c in zip(held, cols)]
            key = cols[0]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))                  # the last key may go on in the next batch
            if len(key) - last > most or key[-1] == hot:
                last, now = len(key), key[-1]
            else:
                now = None
            yield from counted([c[:last] for c in cols])
            held = [c[last:] for c in cols]
            hot = now if now is not None else hot
        if held is not None:
            yield from counted(held)

    return run


def _allot(percent: int):
    """Each set's asks that have company -> the keys it must ask."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, size, asks in zip(*(b.column(c).to_pylist() for c in ("id", "size", "asks"))):
                n, costs = size & 0xFFFFFFFF, {}
                for a in asks:
                    if a["kind"] & ASKS:
                        if a["company"]:
                            costs[a["unit"], 0] = costs.get((a["unit"], 0), 0) + a["company"]
                        if a["wider"]:
                            costs[a["unit"], 1] = costs.get((a["unit"], 1), 0) + a["wider"]
                    elif a["company"]:
                        costs[a["unit"], 1] = costs.get((a["unit"], 1), 0) + a["company"]
                chosen = allotment(n, percent, costs)
                out += {(a["key"], i, size) for a in asks if (a["unit"], 1) in chosen or (a["kind"] & ASKS and (a["unit"], 0) in chosen)}
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return run


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _candidates(skip: int, leaders: int, percent: int):
    """Of rows sorted by key, askers first (``asks`` 2 or 3): each row with those of ``leaders``
    leaders of its key, after the first ``skip``, that are not connected with it and
    not too far from its size and parities.  A row with null a says that the key has more leaders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        place, ahead, beyond, apart, group, more = 0, [], False, False, None, False
        for b in batches:
            pairs = set()
            for k, asks, i, size, c, parity in zip(*(b.column(x).to_pylist() for x in ("key", "asks", "id", "size", "component", "parity"))):
                if k != key:
                    key, group = k, c
                    place, ahead, beyond, apart = 0, [], False, False
                n, own = size & 0xFFFFFFFF, int.from_bytes(parity, "little")
                for j, jn, jc, other in ahead:
                    if c != jc and ((n, i) < (jn, j) or asks >= 2) and not too_far(n, own, jn, other, percent):
                        pairs.add((min(i, j), max(i, j)))
                if place >= skip and asks >= 2:
                    if len(ahead) < leaders:
                        ahead.append((i, n, c, own))
                    else:
                        beyond = True
                apart = apart or c != group
                more = more or (beyond and apart)
                place += 1
            if pairs:
                x, y = zip(*sorted(pairs))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], schema=_PAIRS)
        if more:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], schema=_PAIRS)

    return run


def _verify(k: int, percent: int):
    """Rows sorted by (a, part, b), the leading texts with null b first: the pairs that are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leading, at = [], None
        for b in batches:
            out = []
            for x, part, y, text in zip(*(b.column(c).to_pylist() for c in ("a", "part", "b", "text"))):
                if (x, part) != at:
                    leading, at = [], (x, part)
                own = shingles(text, k)
                if y is None:
                    leading.append(own)
                    continue
                for lead in leading:
                    common = len(lead & own)
                    if 100 * common >= percent * (len(lead) + len(own) - common):
                        out.append((x, y))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_PAIRS)

    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose sets are linked, by the shingles themselves.
    The comparisons with one set are dealt over several tasks when there are many."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    own = written(texts.join(asked, "id", "left_semi"), "jaccard-texts", free=False)
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / DEAL).cast("int").alias("parts"))
    leading = (parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .join(own.withColumnRenamed("id", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "text"))
    others = (pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
              .join(own.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text"))
    return (leading.union(others).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
            .mapInArrow(_verify(k, percent), "a long, b long").distinct())


def links(texts: DataFrame, reps: DataFrame, sketches: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between the documents ``reps`` (id long) of ``texts`` (id long, text
    binary) that connect what all pairs of ``percent`` % or more would connect.
    ``sketches`` (id, size, parity): the parities of each set."""
    own = written(texts.join(reps, "id", "left_semi").distinct(), "jaccard-texts")
    listed = (own.mapInArrow(_listing(k, percent), "key long, kind int, unit int, id long, size long"))
    met = written(listed.repartition("key").sortWithinPartitions("key").mapInArrow(
        _company(COMPANY), "key long, kind int, unit int, id long, size long, company int, wider int"), "jaccard-keys")
    asks = (met.filter("company > 0 OR wider > 0").groupBy("id", "size")
            .agg(F.collect_list(F.struct("key", "kind", "unit", "company", "wider")).alias("asks"))
            .mapInArrow(_allot(percent), "key long, id long, size long"))
    asks = written(asks, "jaccard-asks", free=False)
    named = met.filter(f"kind & {LISTED | NEAR} > 0").select("key", "id", "size").join(
        asks.select("key").distinct(), "key", "left_semi").withColumn("asks", F.lit(1)).unionByName(asks.withColumn("asks", F.lit(2)))
    meeting = named.groupBy("key", "id", "size").agg(F.bit_or("asks").alias("asks"))
    meeting = written(meeting.join(sketches, ["id", "size"]), "jaccard-meeting")
    order = ("key", F.col("asks").desc(), "id")
    found = tested = groups = None
    skip, leaders = 0, LEADERS
    while True:
        if groups is None:
            named = meeting.withColumn("component", F.col("id"))
        else:
            named = meeting.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
        met = named.repartition("key").sortWithinPartitions(*order).select("key", "asks", "id", "size", "component", "parity")
        met = met.mapInArrow(_candidates(skip, leaders, percent), "a long, b long").distinct()
        if tested is not None:
            met = met.join(tested, ["a", "b"], "left_anti")
        met = written(met, "jaccard-candidates")
        pairs = met.filter("a IS NOT NULL")
        new = written(verified(pairs, own, k, percent), "jaccard-links", free=False)
        found, tested = (new, pairs) if found is None else (found.union(new), tested.union(pairs))
        if not met.filter("a IS NULL").limit(1).count():
            return found
        if new.limit(1).count():
            groups = components(found, free=False).withColumnRenamed("node", "id")
        skip, leaders = skip + leaders, leaders * GROWTH


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``n_shingles`` is the size of the whole text's set of distinct ``k``-word
    shingles, ``component_id`` the smallest doc_id that can be reached over links
    of Jaccard similarity ``percent`` % or more, the row's own included.  A text of fewer
    words is one shingle.  Null, empty and blank texts have an empty set and are linked
    with nothing.  Repeated rows give a row each; rows of one id with different
    texts are one document, linked by any of them.  A row with a null id takes no
    part in links and has a null component.  An empty table gives an empty
    result; extra columns are not read.

    Equal sets collapse first (by their size and 128 bits), so one text of a hot
    group of copies is listed.  Every other pair is verified by its shingles.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must lie above 0 and not above 100")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    sets = written(rows.mapInArrow(_summaries(k), "doc long, n long, h1 long, h2 long, parity binary"), "jaccard-sets")
    own = sets.filter("n > 0 AND doc IS NOT NULL")
    classes = own.groupBy("n", "h1", "h2").agg(F.min("doc").alias("rep"))
    named = written(own.join(classes, ["n", "h1", "h2"]).select("doc", "rep"), "jaccard-classes", free=False)
    least = named.groupBy("doc").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    # an id on different texts connects their classes
    again = named.join(least.filter("rep < last").select("doc", F.col("rep").alias("b")), "doc").filter("rep > b").select(F.col("rep").alias("a"), "b")
    size = F.col("n").bitwiseOR(F.shiftleft(F.shiftrightunsigned("h1", 33), 32))
    sketches = own.select(F.col("doc").alias("id"), size.alias("size"), "parity").distinct()
    found = links(rows.filter("id IS NOT NULL"), named.select(F.col("rep").alias("id")).distinct(), sketches, k, percent)
    groups = components(found.union(again), free=False).withColumnRenamed("node", "rep")
    place = least.join(groups, "rep", "left").select("doc", F.coalesce("component", "rep").alias("component"))
    return (sets.join(place, "doc", "left")
            .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")))
