"""Token counts by the whole-token shortcut.

Offline, once on the driver, every vocabulary string is tested: does it stand as one
pre-token and encode alone as exactly one token? Those that do are counted directly
when they come up as pre-tokens; only the rest is merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bpe import BYTE_SPLIT, PLAIN, Bpe, Memo, encoder, lone_spaces


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings proven to be one pre-token that encodes as itself."""
    own, proven = encoder(path), []
    back = {letter: b for b, letter in enumerate(own.letters)}
    for string, i in own.ids.items():
        try:
            text = bytes(back[c] for c in string).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if own.split(text) == [text] and own.merge(own.symbols(text)) == [i]:
            proven.append(text)
    return proven


class Counter:
    """Counts tokens of texts; ``proven`` pre-tokens are never merged."""

    def __init__(self, own: Bpe, proven: list[str]):
        self.own = own
        self.pretokens = Memo(self._merged, fixed=dict.fromkeys(proven, 1))
        after_space = [p[1:] for p in proven if p[:1] == " " and p[1:2].strip()]
        self.chunks = Memo(self._chunk, fixed=dict.fromkeys(after_space, 1))

    def _merged(self, pretoken: str) -> int:
        return len(self.own.merge(self.own.symbols(pretoken)))

    def _sum(self, pretokens: list[str]) -> int:
        return sum(map(self.pretokens.__getitem__, pretokens))

    def _chunk(self, chunk: str) -> int:
        return self._sum(BYTE_SPLIT.findall(" " + chunk))

    def count(self, text: str | None) -> int:
        total = 0
        for part in self.own.parts(text or ""):
            if part in self.own.special:
                total += 1
            elif PLAIN(part) and lone_spaces(part):
                first, *rest = part.split(" ")
                total += self._sum(BYTE_SPLIT.findall(first)) + sum(map(self.chunks.__getitem__, rest))
            else:
                total += self._sum(self.own.split(part))
        return total


@lru_cache(maxsize=2)
def counter(path: str, proven: tuple[str, ...]) -> Counter:
    return Counter(encoder(path), list(proven))


def token_count(df: DataFrame, text: str, path: str) -> Column:
    """Tokens of a text column under a byte-level vocabulary; null and empty texts: 0.

    What is broadcast is bounded by the vocabulary, not by the data.
    """
    proven = df.sparkSession.sparkContext.broadcast(tuple(whole_tokens(path)))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path, proven.value)
        for batch in batches:
            yield pa.array((own.count(t.as_py()) for t in batch), pa.int64(), size=len(batch))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "bigint")(F.col(text))


def with_counts(df: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Columns of these names are replaced. Null texts count as empty.
    """
    return df.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
            "n_tokens": token_count(df, text, path),
        }
    ).withColumn("over_limit", F.col("n_tokens") > limit)
