"""Exact repeated substrings across documents, found by fixed-block anchors.

A *window* is ``window`` consecutive words of one document. Every window holds a whole
block of the grid 0, b, 2b, ... of its document, with b half a window. So the reference
blocks on that grid are the index, and every rolling block of every document probes it:

1. ``anchors``: index and probes meet in hash buckets. Index entries are merged to the least
   document of each block; probes then stream past them, so a bucket's memory is its part
   of the index, whatever the number of documents that share a block. No pairs are made.
2. ``examined``: a document's anchors are extended to all windows around them, and each
   window gets a 96-bit digest of its words.
3. ``repeats``: the least document of every such window, found in buckets again. Adjoining
   windows that repeat are the maximal exact repeats, whichever document they stem from.

Rows between the steps are packed: many values of a document are one binary cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.staging import stage
from .tidy import released

#: Words longer than this go into a rolling hash by their digest.
LONG = 4096
#: Entries that a task holds before it hands them to their buckets.
HELD = 1 << 20
#: Bits of a rolling hash that are sent beside its bucket.
BITS = 40
#: Bytes of a window's digest.
DIGEST = 12
#: Buckets for each shuffle partition: a partition's share evens out.
SHARE = 4

ENTRIES = "bucket int, kind int, docs binary, counts binary, high binary, low binary"


# --- rolling hashes --------------------------------------------------------------


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """A random number for each byte, and odd powers for places in a word."""
    letters = [xxhash.xxh64_intdigest(bytes([b])) for b in range(256)]
    powers = [1]
    for _ in range(LONG + 1):
        powers.append(powers[-1] * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return np.array(letters, "u8"), np.array(powers, "u8")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def word_hashes(words: list[bytes], step: int = 1 << 16) -> np.ndarray:
    """64-bit hashes of words, a bounded number of bytes at a time."""
    letters, powers = tables()
    out = []
    for at in range(0, len(words), step):
        part = words[at : at + step]
        joined = b" ".join(part) + b" "
        if len(joined) > LONG:
            part = [w if len(w) < LONG else xxhash.xxh3_128_hexdigest(w).encode() for w in part]
            joined = b" ".join(part) + b" "
        raw = np.frombuffer(joined, "u1")
        starts = np.concatenate([[0], np.flatnonzero(raw == 32)[:-1] + 1])
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
        out.append(mixed(np.add.reduceat(letters[raw] * powers[place], starts)))
    return np.concatenate(out) if out else np.zeros(0, "u8")


def rolled(x: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` adjoining numbers, by doubling."""
    total, done, part, span = None, 0, x, 1
    factor = lambda n: np.uint64(pow(0xA0761D6478BD642F, n, 1 << 64))
    left = width
    while left:
        if left & 1:
            total = part if total is None else total[: max(len(total) - span, 0)] + part[done:] * factor(done)
            done += span
        left >>= 1
        if left:
            part = part[: max(len(part) - span, 0)] + part[span:] * factor(span)
            span *= 2
    return mixed(total)


def block_values(words: list[bytes], block: int, buckets: int) -> np.ndarray:
    """Bucket and hash of every rolling block, in one number."""
    if len(words) < block:
        return np.zeros(0, "u8")
    h = rolled(word_hashes(words), block)
    return (h >> np.uint64(BITS)) % np.uint64(buckets) << np.uint64(BITS) | h & np.uint64((1 << BITS) - 1)


# --- entries in buckets ----------------------------------------------------------


class Sender:
    """Gathers (kind, document, values) and packs them into rows by bucket.

    Values are numbers ``high``, and ``low`` where a value has 96 bits. Entries of kind 0
    (the index) are merged to the least document of each value first.
    """

    def __init__(self, buckets: int, wide: bool):
        self.buckets, self.wide = buckets, wide
        self.clear()

    def clear(self) -> None:
        self.held: list[list[tuple[int, np.ndarray]]] = [[], []]
        self.size = 0

    def add(self, kind: int, doc: int, values: np.ndarray) -> None:
        self.held[kind].append((doc, values))
        self.size += len(values)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for kind in (0, 1):
            if self.held[kind]:
                yield self._packed(kind)
        self.clear()

    def _packed(self, kind: int) -> pa.RecordBatch:
        docs = np.repeat([d for d, _ in self.held[kind]], [len(v) for _, v in self.held[kind]]).astype("i8")
        values = np.concatenate([v for _, v in self.held[kind]])
        high, low = (values[:, 0], values[:, 1]) if self.wide else (values, None)
        if kind == 0:
            high, low, docs = least_of(high, low, docs)
        bucket = high % np.uint64(self.buckets) if self.wide else high >> np.uint64(BITS)
        order = np.argsort(bucket.astype("u2" if self.buckets <= 1 << 16 else "u4"), kind="stable")
        bucket, docs, high = bucket[order], docs[order], high[order]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        runs = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (docs[1:] != docs[:-1])]))
        lengths = np.diff(np.append(runs, len(docs))).astype("<u4")
        per = np.searchsorted(runs, cuts)
        width = 8 if self.wide else BITS // 8
        sent = high.astype("<u8").view("u1").reshape(-1, 8)[:, :width]
        columns = [
            pa.array(bucket[cuts[:-1]].astype("i4")),
            pa.array(np.full(len(cuts) - 1, kind, "i4")),
            cells(docs[runs].astype("<i8").tobytes(), per * 8),
            cells(lengths.tobytes(), per * 4),
            cells(sent.tobytes(), cuts * width),
            cells(low[order].astype("<u4").tobytes() if self.wide else b"", cuts * 4 if self.wide else cuts * 0),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "docs", "counts", "high", "low"])


def cells(data: bytes, offsets: np.ndarray) -> pa.Array:
    """A binary column of adjoining parts of ``data``."""
    buffers = [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def least_of(high: np.ndarray, low: np.ndarray | None, docs: np.ndarray) -> tuple:
    """Distinct values in order, each with its least document."""
    order = np.lexsort((docs, high) if low is None else (docs, low, high))
    high, docs = high[order], docs[order]
    new = np.ones(len(high), bool)
    new[1:] = high[1:] != high[:-1]
    if low is not None:
        low = low[order]
        new[1:] |= low[1:] != low[:-1]
        low = low[new]
    return high[new], low, docs[new]


class Bucket:
    """Merges the index entries of one bucket and lets its probes stream past them."""

    def __init__(self, number: int, wide: bool):
        self.number, self.wide, self.parts, self.index = number, wide, [], None

    def opened(self, row: dict) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
        docs, counts = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["counts"], "<u4")
        if self.wide:
            return np.frombuffer(row["high"], "<u8"), np.frombuffer(row["low"], "<u4"), docs, counts
        short = np.frombuffer(row["high"], "u1").reshape(-1, BITS // 8)
        full = np.zeros((len(short), 8), "u1")
        full[:, : BITS // 8] = short
        return full.view("<u8")[:, 0] | np.uint64(self.number << BITS), None, docs, counts

    def add(self, row: dict) -> None:
        high, low, docs, counts = self.opened(row)
        self.parts.append((high, low, np.repeat(docs, counts)))

    def close_index(self) -> None:
        if self.parts:
            high, low, docs = (None if p[0] is None else np.concatenate(p) for p in zip(*self.parts))
            self.index = least_of(high, low, docs)
            self.shared = np.zeros(len(self.index[0]), bool)
        self.parts = []

    def probe(self, row: dict) -> pa.RecordBatch | None:
        """Documents and their values that a smaller document has in the index."""
        if self.parts:
            self.close_index()
        if self.index is None:
            return None
        known, known_low, least = self.index
        high, low, docs, counts = self.opened(row)
        at = np.searchsorted(known, high)
        while True:
            place = np.minimum(at, len(known) - 1)
            same = (at < len(known)) & (known[place] == high)
            if low is None or not (other := same & (known_low[place] != low)).any():
                break
            at = at + other
        owner = np.repeat(np.arange(len(docs)), counts)
        greater = same & (docs[owner] > least[place])
        if not greater.any():
            return None
        self.shared[place[greater]] = True
        found = np.bincount(owner[greater], minlength=len(docs))
        return found_rows(docs[found > 0], found[found > 0], high[greater], None if low is None else low[greater])

    def firsts(self) -> pa.RecordBatch | None:
        """The least documents of values that others were found to share."""
        if self.index is None or not self.shared.any():
            return None
        high, low, docs = (None if c is None else c[self.shared] for c in self.index)
        order = np.argsort(docs, kind="stable")
        keys, counts = np.unique(docs, return_counts=True)
        return found_rows(keys, counts, high[order], None if low is None else low[order])


def found_rows(docs: np.ndarray, counts: np.ndarray, high: np.ndarray, low: np.ndarray | None) -> pa.RecordBatch:
    data = high.astype("<u8")
    if low is not None:
        data = np.column_stack([data.view("<u4").reshape(-1, 2), low.astype("<u4")])
    ends = np.concatenate([[0], np.cumsum(counts)]) * (8 if low is None else DIGEST)
    return pa.RecordBatch.from_arrays([pa.array(docs), cells(data.tobytes(), ends)], ["doc", "found"])


def meet(entries: DataFrame, wide: bool, with_first: bool) -> DataFrame:
    """``doc, found``: values of documents that a smaller document shares.

    ``with_first`` also gives each shared value to its least document. Rows of one document
    come from several buckets. A value's entries lie in one bucket: one for each document,
    after its index entries were merged by every sending task.
    """
    spark = entries.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.repartition(width, "bucket").sortWithinPartitions("bucket", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: c[at].as_py() for n, c in zip(batch.schema.names, batch.columns)}
                if own is None or own.number != row["bucket"]:
                    if own is not None and with_first and (made := own.firsts()) is not None:
                        yield made
                    own = Bucket(row["bucket"], wide)
                if row["kind"] == 0:
                    own.add(row)
                elif (made := own.probe(row)) is not None:
                    yield made
        if own is not None and with_first and (made := own.firsts()) is not None:
            yield made

    return placed.mapInArrow(run, "doc bigint, found binary")


# --- the three steps -------------------------------------------------------------


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space and U+0009 to U+000D)."""
    return (text or "").encode("utf-8").split()


def anchors(df: DataFrame, window: int, buckets: int) -> DataFrame:
    """``doc, found``: rolling blocks of documents that occur on another one's grid."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, False)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                words = split(text.as_py())
                if len(words) < window:
                    continue
                values = block_values(words, block, buckets)
                sender.add(0, doc.as_py(), np.unique(values[::block]))
                sender.add(1, doc.as_py(), np.unique(values))
                if sender.size >= HELD:
                    yield from sender.rows()
        yield from sender.rows()

    rows = df.where("doc is not null").select("doc", "text")
    return meet(rows.mapInArrow(run, ENTRIES), False, True)


def kept_form(words: list[bytes], as_text: bool) -> str:
    joined = b" ".join(words)
    return joined.decode("utf-8") if as_text else hashlib.sha256(joined).hexdigest()


def per_document(found: DataFrame) -> DataFrame:
    """All values of a document in one row: at most its number of windows."""
    return found.groupBy(F.col("doc").alias("of")).agg(F.collect_list("found").alias("found"))


def window_digests(joined: bytes, words: list[bytes], starts: np.ndarray, window: int) -> list[bytes]:
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = np.concatenate([[0], ends])
    spans = zip(begin[starts].tolist(), (ends[starts + window - 1] - 1).tolist())
    return [xxhash.xxh3_128_digest(joined[a:b])[:DIGEST] for a, b in spans]


EXAMINED = "doc bigint, n_words bigint, kept string, words binary, starts binary, digests binary"


def examined(df: DataFrame, hits: DataFrame, window: int, buckets: int, as_text: bool) -> DataFrame:
    """Every document with the starts and digests of the windows around its anchors.

    One without such windows is done: it has its ``kept`` and no ``words``.
    """
    block = window // 2

    def windows(words: list[bytes], found: list[bytes]) -> np.ndarray:
        values = block_values(words, block, buckets)
        hit = np.flatnonzero(np.isin(values, np.unique(np.frombuffer(b"".join(found), "<u8"))))
        steps = np.zeros(len(words) - window + 2, "i8")
        first, last = np.maximum(hit - (window - block), 0), np.minimum(hit, len(words) - window)
        np.add.at(steps, first[first <= last], 1)
        np.add.at(steps, last[first <= last] + 1, -1)
        return np.flatnonzero(np.cumsum(steps)[:-1] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc, text, found in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    words = split(text)
                    starts = windows(words, found) if found and len(words) >= window else ()
                    if not len(starts):
                        rows.append((doc, len(words), kept_form(words, as_text), None, None, None))
                        continue
                    joined = b" ".join(words)
                    digests = b"".join(window_digests(joined, words, starts, window))
                    rows.append((doc, len(words), None, joined, starts.astype("<u4").tobytes(), digests))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n_words", "kept", "words", "starts", "digests"])

    joined = df.join(per_document(hits), F.col("doc") == F.col("of"), "left").select("doc", "text", "found")
    return joined.mapInArrow(run, EXAMINED)


def repeats(found: DataFrame, buckets: int) -> DataFrame:
    """``doc, found``: digests of windows that a smaller document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(buckets, True)
        for batch in batches:
            for doc, digests in zip(batch.column(0), batch.column(1)):
                parts = np.frombuffer(digests.as_py(), "<u4").reshape(-1, 3).astype("u8")
                values = np.unique(np.column_stack([parts[:, 1] << np.uint64(32) | parts[:, 0], parts[:, 2]]), axis=0)
                sender.add(0, doc.as_py(), values)
                sender.add(1, doc.as_py(), values)
                if sender.size >= HELD:
                    yield from sender.rows()
        yield from sender.rows()

    rows = found.where("digests is not null and doc is not null").select("doc", "digests")
    return meet(rows.mapInArrow(run, ENTRIES), True, False)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def cut(found: DataFrame, repeated: DataFrame, window: int, as_text: bool, key: str) -> DataFrame:
    """The result: words under repeated windows go."""
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", SPANS),
            T.StructField("kept", T.StringType()),
        ]
    )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]

    def one(n: int, kept: str | None, joined: bytes | None, starts: bytes | None, gone: list | None) -> tuple:
        if joined is None:
            return n, 0, [], kept
        words = joined.split()
        bad = {d[i : i + DIGEST] for d in gone or () for i in range(0, len(d), DIGEST)}
        at = np.frombuffer(starts, "<u4").astype("i8")
        # digests made again: they would be a third of what the join moves
        at = at[np.array([d in bad for d in window_digests(joined, words, at, window)], bool)] if bad else at[:0]
        steps = np.zeros(n + 1, "i8")
        np.add.at(steps, at, 1)
        np.add.at(steps, at + window, -1)
        covered = np.cumsum(steps)[:-1] > 0
        turns = np.flatnonzero(np.diff(np.concatenate([[0], covered.view("i1"), [0]])))
        spans = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
        left = [w for w, c in zip(words, covered.tolist()) if not c]
        return n, int(covered.sum()), spans, kept_form(left, as_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = [(d, *one(*r)) for d, *r in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema.names)

    joined = found.drop("digests").join(per_document(repeated), F.col("doc") == F.col("of"), "left")
    return joined.select("doc", "n_words", "kept", "words", "starts", "found").mapInArrow(run, schema)


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, as_text: bool = True
) -> DataFrame:
    """``key, n_words, n_removed, spans, kept`` of every row of ``df``.

    A word goes if a window over it also starts in a document with a smaller ``key``.
    Windows are judged on the input. ``spans`` are the maximal repeats (word offsets, end
    exclusive); ``kept`` is the text of the words that stay, joined by one space, or with
    ``as_text=False`` its SHA-256 in lowercase hex.

    ``key`` must be of an integer type. Rows that repeat a key are one document to each other:
    neither loses words for the other's sake. Rows without a key keep all words and cost
    others none. Null and empty texts have no words; an empty table gives no rows.
    """
    if not isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{key} must be an integer column")
    if window < 2:
        raise ValueError("a window has two words or more")
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    buckets = bucket_count(spark)
    with released(spark):
        hits = stage(anchors(rows, window, buckets), "anchors")
        found = stage(examined(rows, hits, window, buckets, as_text), "examined")
        repeated = stage(repeats(found, buckets), "repeats")
    return cut(found, repeated, window, as_text, key)


def bucket_count(spark: SparkSession) -> int:
    return min(SHARE * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 20)
