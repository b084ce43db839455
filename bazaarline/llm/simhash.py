"""Near-duplicate documents: 64-bit SimHash linked through the perfect Golay code.

Two fingerprints link if they differ in at most three bits. The 64 bits are three segments
of 23, 23 and 18 bits; a segment is read as a word of the binary Golay code (23, 12),
whose balls of radius three fill the space, so each word decodes to exactly one of 4096
codeword indices. Flipping one bit of a word gives its one or six *near* indices, and a
word at distance one of it decodes to one of those. Three differing bits fall on the
segments in one of two ways (pigeonhole):

* some segment has none and another at most one: join on the equal segment and on the
  other's index, near indices on one side;
* each segment has exactly one: join on the three indices, near indices on one side.

The true distance is part of the join condition, so only links leave the join. Both
joins are on distinct fingerprints: copies cost nothing, and a group of any size links
through its one fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.staging import spread, stage
from .components import components
from .names import fresh

#: Bits of the three segments, from the lowest.
WIDTHS = (23, 23, 18)
SEED = 42
#: Generator polynomial of the binary Golay code (fixed value).
GENERATOR = 0xC75


# --- fingerprints ----------------------------------------------------------------


def simhash(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of all shingles of a whole text; no words: 0."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for word in words:
        starts.append(starts[-1] + len(word) + 1)
    ends = starts[shingle:] if len(words) > shingle else [starts[-1]]
    digest = xxhash.xxh64_intdigest
    total, counted = np.zeros(64, "i8"), 0
    for at in range(0, len(ends), 1 << 16):
        pairs = zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])
        hashes = np.array([digest(joined[a : b - 1], seed) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view("u1"), bitorder="little").reshape(-1, 64)
        total += bits.sum(0, dtype="i8")
        counted += len(hashes)
    return int(np.packbits(2 * total > counted, bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """SimHash of a text column as a long; null is the empty text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((simhash(t.as_py(), shingle) for t in batch), pa.int64(), size=len(batch))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(F.col(text) if isinstance(text, str) else text)


# --- Golay keys ------------------------------------------------------------------


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """``leaders`` by syndrome (the nearest codeword's error) and ``syndromes`` of all words."""
    words = np.arange(1 << 23, dtype="u4")
    syndromes = words.copy()
    for bit in range(22, 10, -1):
        syndromes ^= np.where(syndromes >> bit & 1, np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
    leaders = np.zeros(1 << 11, "u4")
    ones = [1 << i for i in range(23)]
    errors = {0} | {a | b | c for a in ones for b in ones for c in ones}
    for error in errors:
        leaders[syndromes[error]] = error
    return leaders, syndromes


def decode(words: np.ndarray) -> np.ndarray:
    """Codeword index (the 12 message bits) of each 23-bit word."""
    leaders, syndromes = golay()
    return ((words ^ leaders[syndromes[words]]) >> 11).astype("i8")


def segments(prints: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for width in WIDTHS:
        out.append((prints >> np.uint64(at) & np.uint64((1 << width) - 1)).astype("u4"))
        at += width
    return out


def near(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, index)``: the distinct indices of each word and its one-bit neighbours."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype("u4")
    found = np.sort(decode(words[:, None] ^ flips), axis=1)
    keep = np.ones(found.shape, bool)
    keep[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, _ = np.nonzero(keep)
    return rows, found[keep]


def keys(prints: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of fingerprints; ``wide`` gives the near indices.

    A key's top bits say which segments it is of, so different kinds never meet.
    """
    parts = segments(prints)
    own = np.arange(len(prints))
    index = [near(w, n) if wide else (own, decode(w)) for w, n in zip(parts, WIDTHS)]
    rows, made = [], []
    for i in range(3):  # segment i equal, segment j within one bit
        for j in range(3):
            if i != j:
                r, k = index[j]
                rows.append(r)
                made.append((i * 3 + j) << 40 | parts[i][r].astype("i8") << 12 | k)
    r, k = index[0]
    for next_rows, next_index in index[1:]:  # all three within one bit
        r, k = matched(r, k, next_rows, next_index)
    rows.append(r)
    made.append(15 << 40 | k)
    return np.concatenate(rows), np.concatenate(made)


def matched(rows: np.ndarray, k: np.ndarray, more: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every key of a row with every index of the same row; ``more`` is in order."""
    first = np.searchsorted(more, rows)
    count = np.searchsorted(more, rows, "right") - first
    take = np.repeat(np.arange(len(rows)), count)
    at = np.arange(len(take)) - np.repeat(np.cumsum(count) - count, count) + first[take]
    return rows[take], k[take] << 12 | index[at]


def key_rows(prints: DataFrame, wide: bool, block: int = 512) -> DataFrame:
    """``key, fp`` of the column ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), block):
                part = values[at : at + block]
                rows, made = keys(part.view("u8"), wide)
                yield pa.RecordBatch.from_arrays([pa.array(made), pa.array(part[rows])], ["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key bigint, fp bigint")


def links(prints: DataFrame, most: int = 3) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints that differ in at most ``most`` (3) bits."""
    if most > 3:
        raise ValueError("the keys find at most three differing bits")
    # a fingerprint is few bytes but many keys: by file size, too many would share a task
    prints = spread(prints.select("fp"), "fp")
    left = key_rows(prints, True).withColumnRenamed("fp", "a")
    right = key_rows(prints, False).withColumnRenamed("fp", "b")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = left.join(right, (left.key == right.key) & (F.col("a") < F.col("b")) & (apart <= most))
    return found.select("a", "b").distinct()


# --- groups ----------------------------------------------------------------------


def groups(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3) -> DataFrame:
    """``id, text_hash, fp, component_id`` of every row; see ``near_duplicates``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("id"), F.xxhash64(whole).alias("text_hash"), fingerprint(whole).alias("fp"))
    prints = stage(rows, "simhash")
    nodes = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    linked = components(stage(links(nodes, most), "links"), "a", "b")
    members = stage(nodes.join(linked, nodes.fp == linked.node).select("fp", "root", "least"), "members")
    roots = members.groupBy("root").agg(F.min("least").alias("component"))
    moved = stage(members.join(roots, "root").select(F.col("fp").alias("moved"), "component"), "moved")
    component = F.coalesce("component", "least").alias("component_id")
    labels = nodes.join(moved, F.col("fp") == F.col("moved"), "left").select(F.col("fp").alias("print"), component)
    return prints.join(stage(labels, "labels"), F.col("fp") == F.col("print")).drop("print")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3) -> DataFrame:
    """``key, fingerprint, component_id`` of every row.

    ``component_id`` is the smallest ``key`` that can be reached over links, itself
    included; null keys are passed over, and it is null only where all are. Null and
    empty texts have fingerprint zero and link like any other.
    """
    found = groups(df, key, text, most)
    print_ = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select(F.col("id").alias(key), print_, "component_id")


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3) -> DataFrame:
    """``df`` with one document of each group: that of the smallest key.

    Rows that repeat both the kept key and its text stay together, as do all rows of a group
    without any key.
    """
    return first_of_each(df, groups(df, key, text, most), key, text)


def first_of_each(df: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``df`` that have the smallest key of their group in ``found``."""
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id")))
    own_id, own_hash = fresh(df, "_id"), fresh(df, "_hash")
    kept = stage(kept.select(F.col("id").alias(own_id), F.col("text_hash").alias(own_hash)), "kept")
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return df.join(kept, F.col(key).eqNullSafe(F.col(own_id)) & (text_hash == F.col(own_hash)), "left_semi")
