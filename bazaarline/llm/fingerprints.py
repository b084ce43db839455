"""Document fingerprints by content-defined chunking.

A gear hash rolls over a text's bytes and cuts it where the hash has zero bits at the top:
more of them before the normal chunk size than after it (normalised chunking), never
before the least size and always at the most. A cut depends on the last sixteen bytes
only, so an insertion moves chunks without changing them. The fingerprint is the set of
chunk digests with their lengths, and a text's containment in another is the share of
its length whose chunks the other has too.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .neighbours import in_order

#: A stored chunk: six bytes of digest and one of length.
ENTRY = np.dtype([("digest", "u1", 6), ("length", "u1")])


@dataclass(frozen=True)
class Chunking:
    """Sizes in bytes; ``normal`` is a power of two and ``most`` at most 255."""

    least: int = 8
    normal: int = 32
    most: int = 128
    #: Bits more before the normal size, and fewer after it.
    level: int = 1

    def masks(self) -> tuple[int, int]:
        bits = self.normal.bit_length() - 1
        top = lambda n: ((1 << n) - 1) << (16 - n)
        return top(bits + self.level), top(bits - self.level)


@lru_cache(maxsize=1)
def gear() -> np.ndarray:
    """A pseudo-random number for each byte."""
    return np.array([int.from_bytes(blake2b(bytes([b]), digest_size=2).digest(), "little") for b in range(256)], "u2")


def gear_hashes(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: sixteen bits, so bytes further back are shifted out."""
    out = gear()[np.frombuffer(data, "u1")]
    for width in (1, 2, 4, 8):  # windows of 2, 4, 8, 16 bytes from two of half the size
        longer = out.copy()
        longer[width:] += out[:-width] << np.uint16(width)
        out = longer
    return out


def cuts(data: bytes, how: Chunking) -> list[int]:
    """Ends of the chunks; the last is the length of the text."""
    n, out, start = len(data), [], 0
    strict_mask, loose_mask = how.masks()
    hashes = gear_hashes(data)
    loose = np.flatnonzero((hashes & np.uint16(loose_mask)) == 0)
    strict = loose[(hashes[loose] & np.uint16(strict_mask)) == 0] + 1
    loose, strict = (loose + 1).tolist(), strict.tolist()
    at_strict = at_loose = 0
    while n - start > how.least:
        at_strict = bisect_left(strict, start + how.least, at_strict)
        if at_strict < len(strict) and strict[at_strict] < start + how.normal:
            start = strict[at_strict]
        else:
            at_loose = bisect_left(loose, start + how.normal, at_loose)
            end = min(start + how.most, n)
            start = min(loose[at_loose], end) if at_loose < len(loose) else end
        out.append(start)
    if start < n:
        out.append(n)
    return out


def chunk_set(text: str | None, how: Chunking) -> dict[int, int]:
    """Length by digest of the distinct chunks; a null text is empty and has none."""
    data = (text or "").encode("utf-8")
    out, start = {}, 0
    if data:
        digest = xxhash.xxh64_intdigest
        for end in cuts(data, how):
            out[digest(data[start:end]) >> 16] = end - start
            start = end
    return out


def written(chunks: dict[int, int]) -> str:
    made = np.zeros(len(chunks), ENTRY)
    digests = np.array(sorted(chunks), "<u8")
    made["digest"] = digests.view("u1").reshape(-1, 8)[:, :6]
    made["length"] = [chunks[d] for d in digests.tolist()]
    return base64.b64encode(made.tobytes()).decode()


def parsed(fingerprint: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Digests in ascending order, and lengths."""
    made = np.frombuffer(base64.b64decode(fingerprint or ""), ENTRY)
    wide = np.zeros((len(made), 8), "u1")
    wide[:, :6] = made["digest"]
    return wide.view("<u8").ravel(), made["length"].astype("i8")


def contained(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's chunk length that b has; 1 for two empty sets, else 0 for an empty one."""
    if not a:
        return float(not b)
    return sum(n for digest, n in a.items() if digest in b) / sum(a.values())


def shared(a: str | None, b: str | None) -> float:
    """``contained`` of two written fingerprints."""
    return contained(*(dict(zip(*(x.tolist() for x in parsed(p)))) for p in (a, b)))


def fingerprint(text: Column | str, how: Chunking = Chunking()) -> Column:
    """Fingerprint of a text column as base64 text; null and empty texts give ''."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((written(chunk_set(t.as_py(), how)) for t in batch), pa.string(), size=len(batch))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(F.col(text) if isinstance(text, str) else text)


def containment(a: str, b: str) -> Column:
    """How much of the text behind fingerprint ``a`` is in the one behind ``b``: 0 to 1."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            pairs = zip(left, right)
            yield pa.array((shared(x.as_py(), y.as_py()) for x, y in pairs), pa.float64(), size=len(left))

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(F.col(a), F.col(b))


def edited_and_next(df: DataFrame, key: str = "doc_id", text: str = "text", how: Chunking = Chunking()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near it is to that and to
    the next document's.

    The edited text has its last quarter of code points replaced by as many first ones of
    the next document in ascending key order (after the last: the first). Null texts are
    empty; null keys come first; a single row follows itself. Texts are moved once, and one
    Python pass over a task's rows, in order, makes all the figures.
    """
    whole = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    rows, order = in_order(whole, key, text)
    after = rows.withColumn("_next", F.lead(text).over(order)).where("guest = 0").select(key, text, "_next")
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = (None, {})  # the next text is, as a rule, the following row's own
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, out = batch.slice(at, 512), [[] for _ in names]
                for own, following in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    chunks = ahead[1] if own == ahead[0] else chunk_set(own, how)
                    ahead = (following, chunk_set(following, how))
                    quarter = len(own) // 4
                    edited = own[: len(own) - quarter] + following[:quarter]
                    other = chunk_set(edited, how)
                    values = (
                        len(own), sha256(edited.encode("utf-8")).hexdigest(), written(chunks), written(other),
                        contained(chunks, other), contained(chunks, ahead[1]),
                    )
                    for column, value in zip(out, values):
                        column.append(value)
                arrays = [pa.array(c, kind) for c, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], [key, *names])

    kind = df.schema[key].dataType.simpleString()
    figures = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return after.mapInArrow(run, f"`{key}` {kind}, {figures}")
