"""Hierarchical packing of documents into windows of several context sizes.

Every document is encoded, ended by an id, and routed by its length to the smallest
context size (tier) that holds it; longer ones first give off full windows of the largest
size and only their tail is routed. Tiers are packed from the largest down: a document
opens a window, the gap is filled with the longest whole documents of shorter tiers
that fit, and only when none fits is one cut to close the gap. So windows are full;
the last few ids of a task go to full windows of smaller sizes, and fewer than the
smallest tier are left over for one padded window.

Each scan task packs its own rows in blocks of bounded size and hands open pieces on to
its next block, so nothing is shuffled, no group is gathered, and a lost task is
repeated with the same result. Windows of one tier are dealt to step groups of equal
token numbers so that the attention cost (sum of squared lengths) is balanced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from .bpe import packed, ranked

WIDTH = 4


@dataclass(slots=True)
class Piece:
    doc: object
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // WIDTH

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc, self.start, self.ids[: n * WIDTH], self.doc_tokens)
        return head, Piece(self.doc, self.start + n, self.ids[n * WIDTH :], self.doc_tokens)


class Pool:
    """Pieces by length; a bit mask of the lengths at hand finds the best fit."""

    def __init__(self, window: int):
        self.by_length: list[list[Piece]] = [[] for _ in range(window + 1)]
        self.mask = self.tokens = 0

    def put(self, piece: Piece) -> None:
        n = len(piece)
        if n:
            self.by_length[n].append(piece)
            self.mask |= 1 << n
            self.tokens += n

    def longest(self, most: int) -> int:
        """The greatest length at hand up to ``most``; 0: none."""
        return max((self.mask & ((2 << most) - 1)).bit_length() - 1, 0)

    def take(self, n: int) -> Piece:
        pieces = self.by_length[n]
        piece = pieces.pop()
        if not pieces:
            self.mask &= ~(1 << n)
        self.tokens -= n
        return piece

    def all(self) -> list[Piece]:
        return [p for pieces in self.by_length for p in pieces]


def fill(pool: Pool, tier: int) -> list[Piece]:
    """One window of ``tier`` ids at most; shorter only if the pool runs out."""
    pieces, gap = [], tier
    while gap and pool.mask:
        if n := pool.longest(gap):
            pieces.append(pool.take(n))
            gap -= n
        else:
            head, tail = pool.take((pool.mask & -pool.mask).bit_length() - 1).cut(gap)
            pieces.append(head)
            pool.put(tail)
            gap = 0
    return pieces


def pack_block(pool: Pool, tiers: list[int], last: bool) -> list[tuple[int, list[Piece]]]:
    """Windows (tier, pieces) of a block; open ones go back to the pool unless ``last``."""
    windows = []
    for k, tier in enumerate(tiers):
        below = tiers[k + 1] if k + 1 < len(tiers) else 0
        while pool.longest(tier) > below:
            pieces = fill(pool, tier)
            if sum(map(len, pieces)) == tier:
                windows.append((tier, pieces))
                continue
            for piece in pieces:
                pool.put(piece)
            if not last:
                return windows
            break
    while last and pool.mask:  # what is left is shorter than the last tier tried
        tier = next((t for t in tiers if t <= pool.tokens), tiers[0])
        windows.append((tier, fill(pool, tier)))
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]], tokens: int) -> list[int]:
    """A number for each window: its group of ``tokens`` ids of one tier.

    Costliest windows are dealt first, to and fro over the tier's groups.
    """
    out, made = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        own = [i for i, (t, _) in enumerate(windows) if t == tier]
        own.sort(key=lambda i: -sum(len(p) ** 2 for p in windows[i][1]))
        groups = max(1, round(len(own) * tier / tokens))
        for k, i in enumerate(own):
            lap, at = divmod(k, groups)
            out[i] = made + (groups - 1 - at if lap % 2 else at)
        made += groups
    return out


def pack(
    df: DataFrame,
    path: str,
    ranks: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    tiers: Iterable[int] = (1024, 512, 256, 128, 64),
    block_tokens: int = 1 << 19,
    step_tokens: int = 1 << 16,
) -> DataFrame:
    """Pieces of all documents: ``key, start, length, ids, doc_tokens, sequence_id, offset,
    tier, step_group``; ``ids`` are little-endian unsigned 32-bit integers.

    ``tiers`` must be powers of two. A null text is empty: a document of only ``end_id``.
    Rows are kept apart even where ``key`` repeats or is null. An empty table gives no
    rows. Other columns are not looked at.
    """
    sizes = sorted(tiers, reverse=True)
    if any(t & (t - 1) for t in sizes):
        raise ValueError("tiers must be powers of two")
    fields = [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("step_group", T.LongType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end, pool = ranked(path, ranks), packed([end_id]), Pool(sizes[0])
        first = TaskContext.get().partitionId() << 33
        at = {"window": first, "group": first}
        kind, full = None, []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            windows = full + pack_block(pool, sizes, last)
            full.clear()
            if not windows:
                return
            groups = step_groups(windows, step_tokens)
            rows = [[] for _ in range(len(fields) + 1)]
            for (tier, pieces), group in zip(windows, groups):
                offset = 0
                for p in pieces:
                    values = (p.doc, p.start, len(p), p.ids, p.doc_tokens, at["window"], offset, tier, at["group"] + group)
                    for column, value in zip(rows, values):
                        column.append(value)
                    offset += len(p)
                at["window"] += 1
            at["group"] += max(groups) + 1
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = [key, *(f.name for f in fields)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

        waiting = 0
        for batch in batches:
            kind = batch.column(0).type
            for doc, value in zip(batch.column(0), batch.column(1)):
                name, ids = doc.as_py(), coder.encode(value.as_py()) + end
                total, done = len(ids) // WIDTH, 0
                waiting += total
                while total - done > sizes[0]:
                    head = ids[done * WIDTH : (done + sizes[0]) * WIDTH]
                    full.append((sizes[0], [Piece(name, done, head, total)]))
                    done += sizes[0]
                    if len(full) * sizes[0] >= block_tokens:
                        yield from flush(False)
                        waiting = pool.tokens
                pool.put(Piece(name, done, ids[done * WIDTH :], total))
                if waiting >= block_tokens:
                    yield from flush(False)
                    waiting = pool.tokens
        if kind is not None:
            yield from flush(True)

    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *fields])
    return df.select(key, text).mapInArrow(run, schema)
