"""Exact ranked lexical search over geometric blocks.

Queries come in sets of bounded size; a set's terms are its vocabulary, numbered from the
largest weight to the smallest. For one set:

* ``forward``: one row per document with its length and its query terms. Document counts
  and lengths of the whole corpus are sums over it.
* ``Builder``: documents of a task go to shards of bounded size. In a shard the posting list
  of every term is clustered by document similarity, and each cluster (block) stores the
  coordinatewise maximum of its documents' impacts. A shard lives in its task: its blocks hold
  for one vocabulary, and written out they would be larger than the documents' terms.
* ``Shard.search``: terms of a query in order of falling weight. A document of the list at hand
  that holds an earlier term was met before, so the maxima of the terms that are left bound
  what a block can add. A block is skipped only if that bound is below the k-th score found
  so far; else its documents are scored exactly. All arithmetic is on integers.

Shards give at most k documents per query, and two window steps rank them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.staging import stage
from .names import fresh

#: Bytes that divide terms become spaces; only A-Z are lower-cased.
TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)
#: Dimensions in which documents of a posting list are compared.
SKETCH = 16


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(TERMS).split()


@dataclass
class Queries:
    """A bounded set of queries: ids, their distinct terms, and the vocabulary."""

    ids: list = field(default_factory=list)
    terms: list[list[bytes]] = field(default_factory=list)
    size: int = 0

    def add(self, item: object, text: str | None) -> None:
        own = sorted(set(terms_of(text)))
        self.ids.append(item)
        self.terms.append(own)
        self.size += 8 + sum(map(len, own))

    @property
    def vocabulary(self) -> list[bytes]:
        return sorted({t for own in self.terms for t in own})


def query_sets(items: DataFrame, key: str, text: str, most: int) -> Iterator[Queries]:
    """Queries in sets of at most ``most`` bytes of terms (a longer item is a set of its own).

    The driver holds one set, and one partition of the items, at a time.
    """
    held = Queries()
    for row in items.select(key, text).toLocalIterator():
        held.add(row[0], row[1])
        if held.size >= most:
            yield held
            held = Queries()
    if held.ids:
        yield held


# --- statistics ------------------------------------------------------------------


def forward(df: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc, n, ids, tfs`` of every document with a term: query terms and their counts."""
    spark = df.sparkSession
    known = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    schema = T.StructType(
        [
            df.schema["doc"],
            T.StructField("n", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("tfs", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column(1):
                terms = terms_of(text.as_py())
                held = [(number[t], c) for t, c in Counter(terms).items() if t in number]
                n.append(len(terms))
                ids.append(np.array([i for i, _ in held], "<u4").tobytes())
                tfs.append(np.array([c for _, c in held], "<u4").tobytes())
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return df.select("doc", "text").mapInArrow(run, schema).where("n > 0")


def document_counts(rows: DataFrame, size: int) -> dict[int, int]:
    """Documents that hold each term; a task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, "i8")
        for batch in batches:
            for ids in batch.column(0):
                total[np.frombuffer(ids.as_py(), "<u4")] += 1
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["term", "df"])

    counted = rows.select("ids").mapInArrow(run, "term bigint, df bigint")
    return {r.term: r.df for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()}


@dataclass
class Weights:
    """What a task needs of the corpus: term weights in their order, N and L."""

    number: list[int]  # vocabulary position -> term number, by falling weight
    weight: list[int]  # by term number
    documents: int
    length: int


def weigh(rows: DataFrame, size: int) -> Weights:
    sums = rows.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    counts = document_counts(rows, size)
    made = [math.floor(1000 * math.log((2 * sums.n + 2) / (2 * counts.get(t, 0) + 1))) for t in range(size)]
    order = sorted(range(size), key=lambda t: (-made[t], t))
    number = [0] * size
    for place, t in enumerate(order):
        number[t] = place
    return Weights(number, [made[t] for t in order], sums.n, sums.l or 1)


# --- shards ----------------------------------------------------------------------


def sketches(size: int) -> np.ndarray:
    """A random direction for each term; inner products of sums of them follow the documents'."""
    return np.random.default_rng(7).standard_normal((size, SKETCH)).astype("f4")


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


class Builder:
    """Turns documents into the arrays of a shard."""

    def __init__(self, weights: Weights, block: int):
        self.number = np.array(weights.number, "i8")
        self.weights, self.block = weights, block
        self.directions = sketches(len(weights.weight))

    def impacts(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 50 + 50 * n * self.weights.documents // self.weights.length
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)

    def build(self, n: list[int], ids: list[bytes], tfs: list[bytes]) -> dict[str, np.ndarray]:
        counts = np.array([len(i) // 4 for i in ids], "i8")
        doc = np.repeat(np.arange(len(ids)), counts)
        term = self.number[np.frombuffer(b"".join(ids), "<u4")]
        tf = np.frombuffer(b"".join(tfs), "<u4").astype("i8")
        impact = self.impacts(tf, np.array(n, "i8")[doc])
        order = np.lexsort((term, doc))  # a document's terms from the rarest on
        term, impact = term[order], impact[order]
        ends = np.cumsum(counts)
        first = ends - counts
        vectors = np.zeros((len(ids), SKETCH), "f4")
        for at in range(SKETCH):
            vectors[:, at] = np.bincount(doc, self.directions[term, at] * impact, len(ids))
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

        postings = np.argsort(term, kind="stable")
        lists, heads = np.unique(term[postings], return_index=True)
        members, sizes, of_list, cols, maxima, widths = [], [], [], [], [], []
        for t, a, b in zip(lists.tolist(), heads.tolist(), [*heads[1:].tolist(), len(postings)]):
            at = postings[a:b]  # places of the term in the documents' rows
            own = doc[at]
            label = self.clusters(vectors[own])
            by = np.argsort(label, kind="stable")
            own, at, label = own[by], at[by], np.unique(label[by], return_inverse=True)[1]
            members.append(own)
            sizes.append(np.bincount(label))
            rest = ends[own] - at  # this term and those of smaller weight
            places = ranges(at, rest)
            columns = len(self.number) - t
            top = np.full((label[-1] + 1) * columns, -1)
            np.maximum.at(top, np.repeat(label, rest) * columns + term[places] - t, impact[places])
            held = np.flatnonzero(top >= 0)
            cols.append((held % columns + t).astype("u4"))
            maxima.append(top[held].astype("u4"))
            widths.append(np.bincount(held // columns, minlength=label[-1] + 1))
            of_list.append(label[-1] + 1)
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, "i8")
        return {
            "first": np.append(first, ends[-1] if len(ends) else 0),
            "terms": term.astype("u4"),
            "impacts": impact.astype("u4"),
            "lists": lists,
            "of_list": np.array(of_list),
            "sizes": flat(sizes),
            "members": flat(members),
            "widths": flat(widths),
            "cols": flat(cols),
            "maxima": flat(maxima),
        }

    def clusters(self, vectors: np.ndarray) -> np.ndarray:
        """The most similar of evenly drawn members, for every document of a list."""
        k = -(-len(vectors) // self.block)
        if k == 1:
            return np.zeros(len(vectors), "i8")
        centres = vectors[np.arange(k) * len(vectors) // k]
        return np.argmax(vectors @ centres.T, axis=1)


class Shard:
    """A shard, open for queries."""

    def __init__(self, a: dict[str, np.ndarray], size: int):
        self.first, self.terms, self.impacts = a["first"], a["terms"], a["impacts"]
        self.members, self.cols, self.maxima = a["members"], a["cols"], a["maxima"]
        ends = lambda p: np.concatenate([[0], np.cumsum(a[p], dtype="i8")])
        self.starts, self.rows, blocks = ends("sizes"), ends("widths"), ends("of_list")  # rows: of summaries
        self.blocks = {t: (int(x), int(y)) for t, x, y in zip(a["lists"].tolist(), blocks, blocks[1:])}
        self.vector = np.zeros(size, "i8")
        self.scored = self.skipped = 0

    def score(self, docs: np.ndarray) -> np.ndarray:
        """Exact scores under the query in ``vector``."""
        lengths = self.first[docs + 1] - self.first[docs]
        at = ranges(self.first[docs], lengths)
        return np.add.reduceat(self.vector[self.terms[at]] * self.impacts[at], np.cumsum(lengths) - lengths)

    def search(self, terms: list[int], weights: list[int], k: int, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the ``k`` best with a score above 0 and at least ``bar``;
        the new bar is the k-th score, where there is one."""
        self.vector[terms] = weights
        seen = np.zeros(len(self.first) - 1, bool)
        docs, scores, bar = np.zeros(0, "i8"), np.zeros(0, "i8"), max(bar, 1)
        for t in terms:  # by falling weight
            if t not in self.blocks:
                continue
            a, b = self.blocks[t]
            span = slice(self.rows[a], self.rows[b])
            bounds = np.add.reduceat(self.vector[self.cols[span]] * self.maxima[span], self.rows[a:b] - self.rows[a])
            for i in np.argsort(-bounds, kind="stable").tolist():
                if bounds[i] < bar:
                    break
                own = self.members[self.starts[a + i] : self.starts[a + i + 1]]
                own = own[~seen[own]]
                if not len(own):
                    continue
                seen[own] = True
                self.scored += len(own)
                made = self.score(own)
                good = made >= bar
                if good.any():
                    docs, scores = np.concatenate([docs, own[good]]), np.concatenate([scores, made[good]])
                    if len(docs) >= k:
                        best = np.lexsort((docs, -scores))[:k]
                        docs, scores = docs[best], scores[best]
                        bar = max(bar, int(scores[-1]))
        self.skipped += int((~seen).sum())
        self.vector[terms] = 0
        best = np.lexsort((docs, -scores))[:k]
        return docs[best], scores[best], bar


def search(rows: DataFrame, queries: Queries, weights: Weights, k: int, shard_docs: int, shard_terms: int, block: int) -> DataFrame:
    """``query`` (place in the set), ``doc, score, shard``: the ``k`` best of every shard.

    A shard closes at ``shard_docs`` documents or ``shard_terms`` postings; its documents are in
    ascending order, nulls last. Documents without a query term score 0 and are left out.
    """
    spark = rows.sparkSession
    number = dict(zip(queries.vocabulary, weights.number))
    asked = [sorted(number[t] for t in own) for own in queries.terms]
    sent = spark.sparkContext.broadcast((asked, weights))
    schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            rows.schema["doc"],
            T.StructField("score", T.LongType()),
            T.StructField("shard", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = sent.value
        made, weight, name = Builder(weights, block), weights.weight, TaskContext.get().partitionId() << 32
        bars = [0] * len(asked)  # a k-th score of one shard holds for the next
        held: list[pa.RecordBatch] = []
        docs = postings = 0

        def close() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            table = table.take(pc.sort_indices(table.column(0), null_placement="at_end"))
            shard = Shard(made.build(*(table.column(i).to_pylist() for i in (1, 2, 3))), len(weight))
            keys = table.column(0).combine_chunks()
            for q, terms in enumerate(asked):
                found, scores, bars[q] = shard.search(terms, [weight[t] for t in terms], k, bars[q])
                if len(found):
                    own, part = (pa.array(np.full(len(found), v, "i8")) for v in (q, name))
                    yield pa.RecordBatch.from_arrays([own, keys.take(pa.array(found)), pa.array(scores), part], schema.names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, max(1, min(256, shard_docs - docs)))
                held.append(part)
                docs, at = docs + part.num_rows, at + part.num_rows
                postings += pc.sum(pc.binary_length(part.column(2))).as_py() // 4
                if docs >= shard_docs or postings >= shard_terms:
                    yield from close()
                    held, docs, postings, name = [], 0, 0, name + 1
        if held:
            yield from close()

    return rows.where(F.octet_length("ids") > 0).mapInArrow(run, schema)


def ranked(found: DataFrame, k: int, groups: int = 256) -> DataFrame:
    """The ``k`` best of each query: within groups of shards first, so no task sees all."""
    order = (F.col("score").desc(), F.col("doc").asc_nulls_last())
    place = F.pmod(F.xxhash64("shard"), F.lit(groups))
    part = found.withColumn("part", place)
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    part = part.where(F.col("rank") <= k)
    whole = part.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return whole.where(F.col("rank") <= k).select("query", "rank", "doc", "score")


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    set_bytes: int = 8 << 20,
    shard_docs: int = 2048,
    shard_terms: int = 1 << 19,
    block: int = 256,
) -> DataFrame:
    """``item_key, rank, key, score``: the ``k`` best documents above 0 for every item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are
    lower-cased. Equal scores rank by ascending ``key``, null keys last; rows that repeat a
    key and text are ranked each for itself, in any order. A repeated item is answered once for
    each row. Null and empty texts have no terms: as documents they don't count, as items
    they find nothing. Documents are read once for each set of ``set_bytes`` bytes of query
    terms; what is broadcast is bounded by that.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    doc_name = key if key != item_key else fresh(docs, key + "_")
    schema = T.StructType(
        [
            T.StructField(item_key, items.schema[item_key].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField(doc_name, docs.schema[key].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    out = spark.createDataFrame([], schema)
    for queries in query_sets(items, item_key, item_text, set_bytes):
        vocabulary = queries.vocabulary
        held = stage(forward(rows, vocabulary), "forward")
        weights = weigh(held, len(vocabulary))
        best = stage(ranked(search(held, queries, weights, k, shard_docs, shard_terms, block), k), "ranked")
        names = T.StructType([T.StructField("own", T.LongType()), T.StructField("item", schema[0].dataType)])
        asked = spark.createDataFrame(list(enumerate(queries.ids)), names)
        made = best.join(asked, F.col("query") == F.col("own"))
        out = out.unionByName(made.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(doc_name), "score"))
    return out
