"""Alignment of two tokenizers over a corpus, with corpus-wide pair counts.

Tokens of A and B are cut into groups where both end at the same byte, and tokens whose byte
ranges overlap are linked. Counting the linked id pairs takes two passes over the texts:

1. Each task adds up its own pairs. The distinct pairs get a minimal perfect hash, and the
   tasks' counts are added into dense vectors indexed by it, which are summed as a tree.
2. Texts are aligned again and every link looks its pair up: the slot of the hash holds the
   pair itself, so an unknown pair is never mistaken for a known one.

Pairs are cut into parts by B id, at most ``part_pairs`` pairs and one more B id each, and
what is broadcast is one part. A B id has at most as many pairs as A has ids, so that bound is
proven. Each part is one more second pass; sums of the parts add up.

A single space between non-spaces starts a token in both tokenizers (proven when they are
loaded), so texts are aligned by the run between spaces, and frequent runs are remembered
within a bound in bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.staging import stage
from .tidy import released

#: A space beside other white space, or at an end: such texts are aligned as a whole.
UNEVEN = re.compile(r"\s | \s|^ | $").search
#: Runs longer than this aren't remembered.
LONGEST = 48
#: Bytes of remembered runs in a worker, by estimate.
MEMO_BYTES = 96 << 20
#: Distinct pairs that a task holds before it hands them on.
HELD = 1 << 21
#: Slots in one row of a count vector.
PIECE = 1 << 16


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Runs(NamedTuple):
    """Alignments of runs: ``pairs`` of run i lie before ``ends[i]``. Runs that cannot be
    aligned have ``good`` False, no links and an empty text."""

    good: np.ndarray
    figures: np.ndarray  # the first four of FIGURES
    pairs: np.ndarray  # A id << 32 | B id of each link
    ends: np.ndarray
    groups: list[str]


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, ranks: str, model: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        bytes_a = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            bytes_a[i] = token
        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.b = partial(pieces.encode, num_threads=1)
        names = [pieces.id_to_piece(i) for i in range(pieces.vocab_size())]
        bytes_b = [
            bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.bytes = bytes_a, bytes_b
        self.lengths = [np.array([len(t) for t in side], "i8") for side in self.bytes]
        # an id as written inside a group and at its end
        numbers = [[str(i) for i in range(len(side))] for side in self.bytes]
        self.names = [[np.array([i + m for i in own], object) for m in (",", mark)] for own, mark in zip(numbers, "|;")]
        # no piece goes on over a space, so no merge does
        self.by_run = not any(" " in piece.decode("utf-8", "replace").lstrip(" ") for piece in bytes_b)

    def runs(self, text: str) -> list[str]:
        """Parts that are aligned each for itself."""
        return [text] if not self.by_run or UNEVEN(text) else text.split(" ")

    def align(self, runs: list[str], as_text: bool = True) -> Runs:
        """``space + run`` for each of the runs, none of them empty; without ``as_text`` groups are not written.

        The good runs are put one after the other: the ends of a run are common ends, so the
        alignment of all is that of each.
        """
        both = [self.a(" " + run) for run in runs], self.b(runs)
        good = np.ones(len(runs), bool)
        counts = [np.array([len(ids) for ids in side], "i8") for side in both]
        ids = [np.fromiter(chain.from_iterable(side), "i8", int(n.sum())) for side, n in zip(both, counts)]
        joined = ["".join(" " + run for run in runs).encode()]
        sizes = [np.array([len(run.encode()) + 1 for run in runs], "i8")]
        for own, n, known, lengths in zip(ids, counts, self.bytes, self.lengths):
            joined.append(b"".join([known[i] for i in own.tolist()]))
            sums, tails = np.concatenate([[0], np.cumsum(lengths[own])]), np.cumsum(n)
            sizes.append(sums[tails] - sums[tails - n])
        if not (joined[0] == joined[1] == joined[2] and (sizes[0] == sizes[1]).all() and (sizes[0] == sizes[2]).all()):
            for at, run in enumerate(runs):
                made = [b"".join([known[i] for i in side[at]]) for side, known in zip(both, self.bytes)]
                good[at] = made[0] == made[1] == b" " + run.encode()
            ids = [own[np.repeat(good, n)] for own, n in zip(ids, counts)]
            counts = [n[good] for n in counts]
        places = np.flatnonzero(good)
        figures, texts = np.zeros((len(runs), 4), "i8"), [""] * len(runs)
        if not len(places):
            return Runs(good, figures, np.zeros(0, "i8"), np.zeros(len(runs), "i8"), texts)

        ends = [np.cumsum(lengths[own]) for lengths, own in zip(self.lengths, ids)]
        first = np.searchsorted(ends[1], ends[0] - self.lengths[0][ids[0]], "right")
        last = np.searchsorted(ends[1], ends[0], "left")
        links = last - first + 1  # B tokens that overlap each A token
        before = np.cumsum(links) - links
        partner = np.arange(int(links.sum())) - np.repeat(before - first, links)
        pairs = np.repeat(ids[0], links) << 32 | ids[1][partner]
        common = ends[1][last] == ends[0]  # A tokens that end a group
        tails = [np.cumsum(n) for n in counts]
        of_run = [np.add.reduceat(v, tails[0] - counts[0]) for v in (common.astype("i8"), links)]
        figures[places] = np.column_stack([*counts, *of_run])
        if not as_text:
            return Runs(good, figures, pairs, np.cumsum(figures[:, 3]), texts)

        # a text per run: the tokens of a group, A before B, each with what follows it
        closes = [common, np.zeros(len(ids[1]), bool)]
        closes[1][last[common]] = True
        group = [np.cumsum(c) - c for c in closes]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        named = np.concatenate([np.where(c, close[own], held[own]) for (held, close), own, c in zip(self.names, ids, closes)])[order]
        cut = np.cumsum(counts[0] + counts[1])
        flat = named.tolist()
        for place, a, b in zip(places.tolist(), [0, *cut.tolist()], cut.tolist()):
            texts[place] = "".join(flat[a:b])[:-1]
        return Runs(good, figures, pairs, np.cumsum(figures[:, 3]), texts)


@lru_cache(maxsize=2)
def aligner(ranks: str, model: str) -> Aligner:
    return Aligner(ranks, model)


class Remembered:
    """Figures of runs by number, for a few texts at a time.

    ``full`` tells that the tables hold more than ``bound`` bytes; ``clear`` starts them anew.
    With a ``table`` the counts of links are looked up, else ``pairs`` are kept.
    """

    def __init__(self, own: Aligner, table: Table | None = None, bound: int = MEMO_BYTES):
        self.own, self.table, self.bound = own, table, bound
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        self.figures: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.size = self.count = 0

    @property
    def full(self) -> bool:
        return self.size > self.bound

    def learn(self, runs: list[str]) -> None:
        made = self.own.align(runs, self.table is not None)
        figures = np.zeros((len(runs), len(FIGURES)), "i8")
        figures[:, :4] = made.figures
        if self.table is not None:
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in self.table.look_up(made.pairs.astype("u8"))[::-1]]
            figures[:, 4], figures[:, 5] = (s[made.ends] - s[made.ends - made.figures[:, 3]] for s in sums)
            self.texts += made.groups
        else:
            self.pairs.append(made.pairs)
        self.numbers.update((r, self.count + i if g else -1) for i, (r, g) in enumerate(zip(runs, made.good.tolist())))
        self.figures.append(figures)
        self.count += len(runs)
        self.size += 300 * len(runs) + sum(map(len, runs)) + (sum(map(len, made.groups)) if self.table else 8 * len(made.pairs))

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of each text's runs; none for a text without tokens."""
        runs = [self.own.runs(text) if text else [] for text in texts]
        new = list({r for own in runs for r in own if r not in self.numbers})
        if new:
            self.learn(new)
        out = [list(map(self.numbers.__getitem__, own)) for own in runs]
        for run in new:
            if len(run) > LONGEST:
                del self.numbers[run]
        return [[] if own and min(own) < 0 else own for own in out]

    def sums(self, numbers: list[list[int]]) -> np.ndarray:
        """The figures of each text."""
        self.figures = [np.concatenate(self.figures)] if self.figures else [np.zeros((0, len(FIGURES)), "i8")]
        out = np.zeros((len(numbers), len(FIGURES)), "i8")
        for row, own in enumerate(numbers):
            if own:
                out[row] = self.figures[0][own].sum(0)
        return out

    def links(self, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and their counts, where run i came up ``times[i]`` times."""
        if not self.pairs:
            return np.zeros(0, "i8"), np.zeros(0, "i8")
        figures = np.concatenate(self.figures)
        return np.concatenate(self.pairs), np.repeat(times, figures[:, 3])


def slices(texts: pa.Array, most: int = 2 << 20) -> Iterator[pa.Array]:
    """Parts of a column of at most ``most`` bytes; a longer text is a part of its own."""
    first = held = 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if at > first and held + size > most:
            yield texts.slice(first, at - first)
            first, held = at, 0
        held += size
    if first < len(texts):
        yield texts.slice(first)


# --- minimal perfect hash --------------------------------------------------------


def spun(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Slots:
    """n distinct keys to n slots: at each level, keys alone on their bit are done.

    Keys that are left after the last level keep their order.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks = [np.cumsum(bits, dtype="i8") - bits for bits in levels]
        self.bases = np.concatenate([[0], np.cumsum([int(bits.sum()) for bits in levels])]).astype("i8")

    @classmethod
    def build(cls, keys: np.ndarray, spare: float = 2.0, most: int = 24) -> Slots:
        levels, left = [], np.unique(keys)
        if len(left) != len(keys):
            raise ValueError("keys repeat")
        while len(left) and len(levels) < most:
            at = spun(left, len(levels)) % np.uint64(max(8, int(spare * len(left))))
            bits = np.bincount(at.astype("i8"), minlength=max(8, int(spare * len(left)))) == 1
            levels.append(bits)
            left = left[~bits[at]]
        return cls(levels, left)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots; any number below n, or -1, for keys that were not built in."""
        out, open_ = np.full(len(keys), -1, "i8"), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = spun(keys[open_], level) % np.uint64(len(bits))
            hit = bits[at]
            out[open_[hit]] = self.bases[level] + ranks[at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            out[open_] = self.bases[-1] + at
        return out

    def stored(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes()
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def opened(cls, data: bytes) -> Slots:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        at, levels = 8 * (n + 1), []
        for size in sizes:
            packed = np.frombuffer(data, "u1", -(-size // 8), at)
            levels.append(np.unpackbits(packed, count=size).astype(bool))
            at += len(packed)
        return cls(levels, np.frombuffer(data, "<u8", -1, at))


class Table:
    """Counts of one part's pairs; whether a count is the highest of its B id."""

    def __init__(self, slots: bytes, keys: bytes, counts: bytes):
        self.slots = Slots.opened(slots)
        self.keys, self.counts = np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8")
        b = self.keys & np.uint64(0xFFFFFFFF)
        tops = np.zeros(int(b.max()) + 1 if len(b) else 1, "i8")
        np.maximum.at(tops, b, self.counts)
        self.tops = self.counts == tops[b]

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and whether they are the highest; 0 and False for pairs of other parts."""
        if not len(self.keys):
            return np.zeros(len(pairs), "i8"), np.zeros(len(pairs), bool)
        at = self.slots.find(pairs)
        known = (at >= 0) & (self.keys[at] == pairs)
        return np.where(known, self.counts[at], 0), known & self.tops[at]


# --- first pass ------------------------------------------------------------------


def observed(df: DataFrame, ranks: str, model: str) -> DataFrame:
    """``pair, b, n``: links of each task's texts, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Remembered(aligner(ranks, model))
        pairs, counts, times = (np.zeros(0, "i8") for _ in range(3))

        def added() -> tuple[np.ndarray, np.ndarray]:
            more, n = memo.links(times)
            keys, place = np.unique(np.concatenate([pairs, more]), return_inverse=True)
            sums = np.zeros(len(keys), "i8")
            np.add.at(sums, place, np.concatenate([counts, n]))
            return keys[sums > 0], sums[sums > 0]

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(pairs & 0xFFFFFFFF), pa.array(counts)], ["pair", "b", "n"])

        for batch in batches:
            for part in slices(batch.column(0)):
                numbers = [n for own in memo.of(part.to_pylist()) for n in own]
                seen = np.bincount(np.array(numbers, "i8"), minlength=memo.count)
                seen[: len(times)] += times
                times = seen
                if memo.full:
                    pairs, counts = added()
                    memo.clear()
                    times = times[:0]
                    if len(pairs) >= HELD:
                        yield sent()
                        pairs, counts = pairs[:0], counts[:0]
        pairs, counts = added()
        yield sent()

    return df.select("text").mapInArrow(run, "pair bigint, b bigint, n bigint")


def parts_of(pairs: DataFrame, most: int) -> dict[int, int]:
    """The part of each B id; the table of B ids is bounded by the vocabulary."""
    sizes = sorted((r.b, r.n) for r in pairs.groupBy("b").agg(F.count("*").alias("n")).collect())
    out, part, held = {}, 0, 0
    for b, n in sizes:
        if held and held + n > most:
            part, held = part + 1, 0
        out[b], held = part, held + n
    return out


def hashed(pairs: DataFrame) -> DataFrame:
    """``slots, keys``: the perfect hash of one part, built in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.column(0).to_numpy().astype("u8") for batch in batches]
        keys = np.concatenate([np.zeros(0, "u8"), *held])
        slots = Slots.build(keys)
        placed = np.zeros(len(keys), "<u8")
        placed[slots.find(keys)] = keys
        yield pa.RecordBatch.from_arrays([pa.array([slots.stored()]), pa.array([placed.tobytes()])], ["slots", "keys"])

    return pairs.select("pair").coalesce(1).mapInArrow(run, "slots binary, keys binary")


def vectors(rows: DataFrame, slots: bytes, size: int) -> DataFrame:
    """``piece, branch, counts``: each task's dense count vector, in pieces."""
    sent = rows.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = Slots.opened(sent.value), np.zeros(size, "<i8")
        for batch in batches:
            if batch.num_rows:
                at = found.find(batch.column(0).to_numpy().astype("u8"))
                np.add.at(total, at, batch.column(1).to_numpy())
        branch = TaskContext.get().partitionId()
        for at in range(0, size, PIECE):
            part = total[at : at + PIECE]
            if part.any():
                values = [pa.array([at // PIECE]), pa.array([branch]), pa.array([part.tobytes()])]
                yield pa.RecordBatch.from_arrays(values, ["piece", "branch", "counts"])

    return rows.select("pair", "n").mapInArrow(run, "piece bigint, branch bigint, counts binary")


def tree_sum(pieces: DataFrame, fan: int = 32) -> DataFrame:
    """``piece, branch, counts`` summed by piece: first within ``fan`` branches, then whole.

    A task adds up the vectors of one key as they stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = total = None

        def made() -> pa.RecordBatch:
            values = [pa.array([key[0]]), pa.array([key[1]]), pa.array([total.tobytes()])]
            return pa.RecordBatch.from_arrays(values, ["piece", "branch", "counts"])

        for batch in batches:
            for piece, branch, counts in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(counts, "<i8")
                if key == (piece, branch):
                    total += own
                    continue
                if key is not None:
                    yield made()
                key, total = (piece, branch), own.copy()
        if key is not None:
            yield made()

    for branch in (F.pmod(F.col("branch"), F.lit(fan)), F.lit(0)):
        placed = pieces.withColumn("branch", branch.cast("long")).repartition("piece", "branch")
        pieces = placed.sortWithinPartitions("piece", "branch").mapInArrow(run, pieces.schema)
    return pieces


def tables(df: DataFrame, ranks: str, model: str, part_pairs: int) -> list[tuple[bytes, bytes, bytes]]:
    """``Table`` arguments of every part."""
    spark = df.sparkSession
    with released(spark):
        rows = stage(observed(df, ranks, model), "observed")
        pairs = stage(rows.select("pair", "b").distinct(), "pairs")
        parts = parts_of(pairs, part_pairs)
        out = []
        for part in range(max(parts.values(), default=-1) + 1):
            own = [b for b, p in parts.items() if p == part]
            here = F.col("b").between(own[0], own[-1])
            slots, keys = hashed(pairs.where(here)).first()
            size = len(keys) // 8
            counts = np.zeros(size, "<i8")
            for r in tree_sum(vectors(rows.where(here), bytes(slots), size)).collect():
                counts[r.piece * PIECE : (r.piece + 1) * PIECE] += np.frombuffer(r.counts, "<i8")
            out.append((bytes(slots), bytes(keys), counts.tobytes()))
    return out


# --- second pass -----------------------------------------------------------------


def looked_up(df: DataFrame, table: tuple | None, ranks: str, model: str, as_text: bool, add: bool) -> DataFrame:
    """``df`` with the figures of its texts; ``add`` adds one more part's counts to them."""
    sent = df.sparkSession.sparkContext.broadcast(table or (Slots([], np.zeros(0, "u8")).stored(), b"", b""))
    keep = [f for f in df.schema if f.name not in (*FIGURES, "groups")]
    schema = T.StructType(keep + [T.StructField(f, T.LongType()) for f in FIGURES] + [T.StructField("groups", T.StringType())])
    columns = [df[f.name] for f in keep] + [df[f] for f in (*FIGURES, "groups") if add]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Remembered(aligner(ranks, model), Table(*sent.value))
        text_at = [f.name for f in keep].index("text")
        for batch in batches:
            sums, groups = [], []
            for part in slices(batch.column(text_at)):
                numbers = memo.of(part.to_pylist())
                sums.append(memo.sums(numbers))
                for own in numbers if not add else ():
                    joined = ";".join([memo.texts[i] for i in own])
                    groups.append(joined if as_text or not joined else hashlib.sha256(joined.encode()).hexdigest())
                if memo.full:
                    memo.clear()
            figures = np.concatenate(sums) if sums else np.zeros((0, len(FIGURES)), "i8")
            made = [pa.array(figures[:, i]) for i in range(len(FIGURES))]
            if add:
                old = batch.columns[len(keep) :]
                made = [*old[:4], *(pa.array(figures[:, i] + old[i].to_numpy()) for i in (4, 5))]
                groups = old[6]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made, pa.array(groups, pa.string())], schema.names)

    return df.select(*columns).mapInArrow(run, schema)


def aligned(
    df: DataFrame,
    ranks: str,
    model: str,
    key: str = "doc_id",
    text: str = "text",
    as_text: bool = True,
    part_pairs: int = 1 << 21,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row of ``df``.

    ``n_best`` counts links whose pair count is the highest of its B id in the corpus, ties
    included; ``count_sum`` adds up the pair counts of all links. ``groups`` is written
    ``a1,a2|b1;a3|b2,b3``, or as its SHA-256 in lowercase hex with ``as_text=False``.

    A is a byte-level vocabulary's rank file, B a SentencePiece model; both take a text with a
    space before it, and special strings inside are plain text. Null and empty texts, and
    those whose token bytes differ from the text, have no tokens: zeros and an empty
    ``groups``, and they add nothing to the counts. Keys may be null or repeat: rows are
    counted and answered one by one. An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    made = tables(rows, ranks, model, part_pairs)
    out = looked_up(rows, made[0] if made else None, ranks, model, as_text, False)
    for table in made[1:]:
        out = looked_up(stage(out, "aligned"), table, ranks, model, as_text, True)
    return out.select(F.col("doc").alias(key), *FIGURES, "groups")
