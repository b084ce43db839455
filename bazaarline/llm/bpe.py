"""Byte-pair encoding and decoding over texts of any length.

A text is cut into pre-tokens, each pre-token is merged by a priority queue of merge
ranks over a doubly linked list of symbols, and decoding joins vocabulary strings.
Results equal those of the ``tokenizers`` library for two kinds of vocabulary files:
``byte`` (spaces belong to the following word) and ``word`` (lower case, white space
dropped, word ends marked). The path of the file is a parameter and must exist on every
machine. Pre-tokens are memoised per Python worker under bounds of entries and characters,
so memory doesn't grow with the corpus, whatever its words are.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .names import fresh

#: White space (Unicode White_Space) up to U+017F.
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
#: Letters and numbers of the same range, as character classes.
LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: Texts of these characters are split here; others by the library's own splitter. The
#: range leaves out the dotted capital I (its lower case leaves the range) and the
#: control characters that Python, unlike Unicode, takes for white space.
PLAIN = re.compile("[\x00-\x1b\x20-įı-ſ]*").fullmatch
#: How the two kinds of vocabulary split a text.
BYTE_SPLIT = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{WHITE}{LETTERS}{NUMBERS}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
WORD_SPLIT = re.compile(
    rf"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{WHITE}{LETTERS}{NUMBERS}]+"
)
#: Entries in one generation of a memo.
MEMO = 250_000
#: Characters of the keys of one generation, and of a key that is remembered at all.
MEMO_LETTERS, MEMO_LONGEST = 8 << 20, 256


class Memo(dict):
    """Values of ``make`` by key in two generations of at most ``bound`` entries and
    ``letters`` characters each.

    A full generation becomes the old one and the one before it goes, so frequent keys
    stay. ``fixed`` entries are never dropped. Keys of more than ``longest`` characters are
    made anew each time.
    """

    def __init__(
        self, make: Callable[[str], object], bound: int = MEMO, fixed: dict | None = None,
        letters: int = MEMO_LETTERS, longest: int = MEMO_LONGEST,
    ):
        super().__init__(fixed or {})
        self.make, self.fixed, self.bound = make, dict(fixed or {}), bound + len(fixed or {})
        self.letters, self.longest, self.held = letters, longest, 0
        self.old: dict = {}

    def __missing__(self, key: str):
        if len(key) > self.longest:
            return self.make(key)
        if len(self) >= self.bound or self.held >= self.letters:
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)
            self.held = 0
        self.held += len(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary strings."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.path, self.ids, self.suffix = path, model["vocab"], model["end_of_word_suffix"] or ""
        self.word = bool(self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self.strings = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.made = [self.ids[a + b] for a, b in model["merges"]]
        self.ranks = {
            self.ids[a] << 32 | self.ids[b]: rank for rank, (a, b) in enumerate(model["merges"])
        }
        self.letters = byte_letters()
        self.latin = dict(enumerate(self.letters))
        self.pretokens = Memo(self._pretoken)
        self.chunks = Memo(self._chunk)

    # --- merging -----------------------------------------------------------------

    def symbols(self, pretoken: str) -> list[int]:
        """Ids of the single bytes; the last carries the word end."""
        marks = list(pretoken.encode("utf-8").decode("latin-1").translate(self.latin))
        if marks and self.suffix:
            marks[-1] += self.suffix
        return [self.ids[m] for m in marks if m in self.ids]

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left.

        An entry of the queue is a rank and a position in one number. It is never searched
        for: one whose pair has changed meanwhile is stale and skipped when it comes up.
        """
        n, rank_of = len(symbols), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            rank = rank_of(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or symbols[i] < 0 or rank_of(symbols[i] << 32 | symbols[j]) != entry >> 32:
                continue
            made = symbols[i] = self.made[entry >> 32]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(made << 32 | symbols[k])) is not None:
                    heapq.heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] << 32 | made)) is not None:
                heapq.heappush(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _pretoken(self, pretoken: str) -> bytes:
        return packed(self.merge(self.symbols(pretoken)))

    # --- splitting ---------------------------------------------------------------

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run of text that stands after a space (byte) or between spaces (word)."""
        found = WORD_SPLIT.findall(chunk.lower()) if self.word else BYTE_SPLIT.findall(" " + chunk)
        return b"".join(map(self.pretokens.__getitem__, found))

    @property
    def library(self):
        return library(self.path)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if PLAIN(text):
            return WORD_SPLIT.findall(text.lower()) if self.word else BYTE_SPLIT.findall(text)
        made = self.library
        if made.normalizer is not None:
            text = made.normalizer.normalize_str(text)
        back = {s: b for b, s in enumerate(self.letters)}
        parts = made.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(back[c] for c in part).decode("utf-8") for part, _ in parts]

    def parts(self, text: str) -> Iterator[str]:
        """The text between special strings, and those strings themselves."""
        if not any(s in text for s in self.special):
            return iter((text,))
        return (part for part in self.special_cut.split(text) if part)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null is the empty text."""
        made = []
        for part in self.parts(text or ""):
            if part in self.special:
                made.append(packed([self.special[part]]))
            elif PLAIN(part) and (self.word or lone_spaces(part)):
                chunks = part.split() if self.word else part.split(" ")
                if not self.word:
                    made += map(self.pretokens.__getitem__, BYTE_SPLIT.findall(chunks[0]))
                    del chunks[0]
                made += map(self.chunks.__getitem__, chunks)
            else:
                made += map(self.pretokens.__getitem__, self.split(part))
        return b"".join(made)

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings put together; byte letters give back their bytes.

        A word vocabulary has no decoder: its strings are joined by a space, word ends
        shown, as the library does.
        """
        strings = [self.strings[i] for i in unpacked(ids)]
        if self.word:
            return " ".join(strings)
        back = {s: b for b, s in enumerate(self.letters)}
        out = bytearray()
        for s in strings:
            known = all(c in back for c in s)
            out += bytes(back[c] for c in s) if known else s.encode("utf-8")
        return out.decode("utf-8", "replace")


def lone_spaces(text: str) -> bool:
    """Whether every space stands between non-spaces, so that it starts a pre-token."""
    if "  " in text:
        return False
    others = [w for w in WHITE if w != " " and w in text]
    return not any(f" {w}" in text or f"{w} " in text for w in others)


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    return out


@lru_cache(maxsize=4)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def encoder(path: str) -> Bpe:
    """One per worker process."""
    return Bpe(path)


def encode(text: Column | str, path: str) -> Column:
    """Ids of a text column as binary (little-endian unsigned 32-bit integers).

    Null and empty texts give no ids (empty binary). Special strings inside a text give
    their special id, as the library does by default.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        for batch in batches:
            yield pa.array((own.encode(t.as_py()) for t in batch), pa.binary(), size=len(batch))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(F.col(text) if isinstance(text, str) else text)


def decode(ids: Column | str, path: str) -> Column:
    """Text of a binary column of ids; null ids give the empty text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        for batch in batches:
            yield pa.array((own.decode(i.as_py() or b"") for i in batch), pa.string(), size=len(batch))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(F.col(ids) if isinstance(ids, str) else ids)


def coded(
    df: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, ids: str = "ids", decoded: str = "decoded", rows: int = 256
) -> DataFrame:
    """The columns ``keep`` (default: all) with ``ids`` and their text ``decoded`` again.

    One Python pass that hands on ``rows`` rows at a time, so a task holds the ids and
    texts of a few documents only. Columns called ``ids`` and ``decoded`` are replaced.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in (ids, decoded)]
    made = [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())]
    schema = T.StructType([df.schema[c] for c in keep] + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                encoded = [own.encode(t) for t in part.column(0).to_pylist()]
                arrays = [pa.array(encoded, pa.binary()), pa.array(map(own.decode, encoded), pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays], schema.names)

    return df.select(F.col(text).alias(fresh(df, "_text")), *keep).mapInArrow(run, schema)


class Ranked(Bpe):
    """The same ids, with unseen chunks merged by the rank file of the same vocabulary."""

    def __init__(self, path: str, ranks: str):
        import base64

        import tiktoken
        from public_tokenizers import PATTERN

        super().__init__(path)
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        coder = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.chunks = Memo(lambda chunk: packed(coder.encode_ordinary(" " + chunk)))


@lru_cache(maxsize=4)
def ranked(path: str, ranks: str) -> Ranked:
    return Ranked(path, ranks)
