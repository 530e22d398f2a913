"""Operator 10: best-fit-decreasing packing into windows of a fixed length.

Overlong documents are first cut into full windows; what is left over (always
shorter than a window) is packed best-fit decreasing within groups: a segment
tree over remaining capacities finds the tightest open window that still
holds the piece.  Groups are dealt by a hash of the document and their number
grows with the number of pieces, so no task holds more than a bounded share.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE, Remembered, pre_tokens
from .common import map_rows, written

WINDOW = 2048
END_ID = 1
#: Pieces of a packing group on average: enough that best fit leaves little open.
GROUP_PIECES = 20_000

#: Pre-tokens that a worker remembers, about 200 MB of them.
REMEMBERED = 2 * CACHE
#: Characters of texts whose pre-tokens are held and learnt together; a longer text goes alone.
LEARN_CHARS = 500_000


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The ``tokenizers`` library encodes each pre-token once; pre-tokens are
    merged apart from one another, so a text's ids are its pre-tokens' ids in
    turn.  Special strings inside a text get their own id, the library's
    default.
    """

    def __init__(self, spec: bytes, cache_size: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec.decode())
        self.tok.no_padding()
        self.tok.no_truncation()
        added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.special_ids = {c: i.to_bytes(4, "little") for c, i in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.ids = Remembered(lambda word: array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes(), cache_size)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, pre_tokens(text)))

    def encode(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        return b"".join([self.special_ids[p] if k % 2 else self.plain(p)
                         for k, p in enumerate(self.special.split(text))])

    def learn(self, words: set[str]) -> None:
        """Has the library encode those not remembered in one call, which costs less than one each."""
        new = [w for w in words if w not in self.ids]
        if new and len(self.ids) + len(new) <= self.ids.size:
            for w, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False)):
                self.ids[w] = array("I", e.ids).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of each text; the new pre-tokens of several texts are learnt together."""
        at = 0
        while at < len(texts):
            end, left = at, LEARN_CHARS
            while end < len(texts) and (end == at or left >= len(texts[end])):
                left -= len(texts[end])
                end += 1
            cut = [None if self.special and self.special.search(t) else pre_tokens(t) for t in texts[at:end]]
            self.learn({w for words in cut if words for w in words})
            for t, words in zip(texts[at:end], cut):
                yield self.encode(t) if words is None else b"".join(map(self.ids.__getitem__, words))
            at = end


_ENCODERS: dict[tuple[int, int], Encoder] = {}


def encoder_of(spec: bytes, remembered: int = REMEMBERED) -> Encoder:
    key = hash(spec), remembered
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(spec, remembered)
    return _ENCODERS[key]


class TightestFit:
    """Segment tree indexed by remaining capacity 0..size: leaf c counts the
    open windows with exactly c free places, inner nodes sum their children.
    The tightest window for a piece is the first non-empty leaf at or after
    its length."""

    def __init__(self, size: int):
        self.n = 1 << size.bit_length()
        self.sum = [0] * (2 * self.n)
        self.open: list[list] = [[] for _ in range(size + 1)]

    def _add(self, c: int, d: int) -> None:
        i = c + self.n
        while i:
            self.sum[i] += d
            i >>= 1

    def put(self, capacity: int, window) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def take(self, length: int):
        """(capacity, window) of the tightest open window for ``length``, or None."""
        i = length + self.n
        if not self.sum[i]:
            while i > 1 and (i & 1 or not self.sum[i + 1]):   # up until a right sibling holds something
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.n:                                 # down to its leftmost leaf
                i = 2 * i if self.sum[2 * i] else 2 * i + 1
        c = i - self.n
        self._add(c, -1)
        return c, self.open[c].pop()


class Packer:
    """Places pieces of 1 to ``window`` tokens, best fit, in the order they come
    (falling lengths for best-fit decreasing)."""

    def __init__(self, window: int):
        self.window, self.tree, self.opened = window, TightestFit(window), 0

    def place(self, length: int) -> tuple[int, int]:
        """(window number, offset) of the next piece."""
        found = self.tree.take(length)
        if found is None:
            found = self.window, self.opened
            self.opened += 1
        free, w = found
        if free > length:
            self.tree.put(free - length, w)
        return w, self.window - free


def best_fit(lengths: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(window number, offset) of each piece, taken in the order given."""
    packer = Packer(window)
    return [packer.place(n) for n in lengths]


def pieces(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, window: int, remembered: int = REMEMBERED) -> DataFrame:
    """Each document's ids, end id included, cut into full windows and a rest:
    (doc_id, start, length, ids_crc32, doc_tokens)."""
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    end, step = END_ID.to_bytes(4, "little"), 4 * window

    def run(batch: dict) -> dict:
        out: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        for doc, encoded in zip(batch["doc_id"], encoder_of(spec.value, remembered).encode_all(batch["text"])):
            ids = encoded + end
            for at in range(0, len(ids), step):
                piece = ids[at:at + step]
                for c, v in (("doc_id", doc), ("start", at // 4), ("length", len(piece) // 4),
                             ("ids_crc32", zlib.crc32(piece)), ("doc_tokens", len(ids) // 4)):
                    out[c].append(v)
        return out

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_rows(src, run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, group_pieces: int = GROUP_PIECES, remembered: int = REMEMBERED) -> DataFrame:
    """Pack every document of ``docs`` into windows of at most ``window`` tokens.

    One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit), doc_tokens (end id
    included), sequence_id, offset.  Offsets of a sequence are gapless from 0.
    Null and empty texts are one piece of the end id alone.  Repeated rows and
    rows with a null id are packed each on its own; ties in length go by
    doc_id and start.  An empty table gives no rows; extra columns are not read.

    The texts are read and encoded once; the pieces (five integers each) are
    written to the shared folder with a number for the row, counted, and dealt into
    groups by a hash of the piece and that number, which tells equal pieces apart.  A group holds ``group_pieces`` rows on average whatever the
    input's size and whichever documents are long, since each piece is dealt on
    its own.  Full windows are sequences as they are and skip the packing.
    ``remembered``: pre-tokens whose ids a worker keeps; fewer cost time, not results.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, vocabulary, id_col, text_col, window, remembered).withColumn("row", F.monotonically_increasing_id()), "pieces")
    rest = cut.filter(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_pieces))
    dealt = (rest.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(groups))).drop("row")
             .repartition(min(groups, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "grp")
             .sortWithinPartitions("grp", F.col("length").desc(), "doc_id", "start", "ids_crc32"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups arrive in order, each sorted by falling length; only window
        numbers and free places are kept from batch to batch."""
        current, packer = None, Packer(window)
        for b in batches:
            sequence, offset = [], []
            for g, length in zip(b.column("grp").to_pylist(), b.column("length").to_pylist()):
                if g != current:
                    current, packer = g, Packer(window)
                w, at = packer.place(length)
                sequence.append(w * groups + g)
                offset.append(at)
            keep = b.drop_columns(["grp"])
            yield pa.RecordBatch.from_arrays(
                [*keep.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*keep.schema.names, "sequence_id", "offset"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = dealt.mapInArrow(run, schema)
    # full windows: even numbers are the packed windows, odd ones the full windows
    full = (cut.drop("row").filter(F.col("length") == window)
            .withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1)
            .withColumn("offset", F.lit(0).cast("long")))
    return packed.withColumn("sequence_id", F.col("sequence_id") * 2).unionByName(full).withColumnRenamed("doc_id", id_col)
