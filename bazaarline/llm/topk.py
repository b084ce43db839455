"""Exact top-k inner products by pivot-table elimination.

Vectors of integers. For every vector the distances to some pivots are computed once and
stored. By the triangle inequality |d(p,q) - d(p,x)| bounds d(q,x) from below, so the
largest of these bounds gives the most that q.x can be: (|q|^2 + |x|^2 - bound^2) / 2.
Candidates are evaluated in the order of that bound until it falls under the k-th best
score, which makes the result exact. Work is dealt out as blocks of queries against
blocks of candidates; each pair of blocks returns at most k rows a query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.staging import new_path


def quantised(vector: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a long."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def usable(vector: Column | str) -> Column:
    """Not null, and every component is a finite number."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def matrix(vectors: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    rows = vectors.combine_chunks()
    if isinstance(rows, pa.ChunkedArray):
        rows = pa.concat_arrays(rows.chunks) if rows.num_chunks else pa.array([], vectors.type)
    offsets = rows.offsets.to_numpy()
    sizes, values = np.diff(offsets), rows.flatten().to_numpy(zero_copy_only=False)
    widest = int(sizes.max(initial=0))
    width = widest if width is None else max(width, widest)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(rows.shape[1], pivots.shape[1])
    rows, pivots = widened(rows, width).astype("f8"), widened(pivots, width).astype("f8")
    squares = (rows**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows far apart: each next one is the farthest from those chosen before."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def best(
    query: np.ndarray, own_id: int, at_pivots: np.ndarray, ids: np.ndarray, rows: np.ndarray,
    norms: np.ndarray, table: np.ndarray, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, scores)`` of a query's k best candidates, best first, ties to smaller ids."""
    lower = np.abs(table - at_pivots).max(1, initial=0.0)
    norm = float((query.astype("f8") ** 2).sum())
    # a little slack, relative to what was rounded, keeps the bound a bound
    slack = 1.0 + 1e-9 * (norm + norms)
    most = (norm + norms - lower**2) / 2 + slack
    most[ids == own_id] = -np.inf
    order = np.argsort(-most, kind="stable")
    order = order[: len(order) - int((ids == own_id).sum())]
    found_ids, found = np.empty(0, "i8"), np.empty(0, "i8")
    at, step = 0, 64
    while at < len(order) and not (len(found) == k and most[order[at]] < found[-1]):
        part = order[at : at + step]
        scores = rows[part] @ query
        found_ids, found = np.concatenate([found_ids, ids[part]]), np.concatenate([found, scores])
        first = np.lexsort((found_ids, -found))[:k]
        found_ids, found = found_ids[first], found[first]
        at, step = at + step, step * 2
    return found_ids, found


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "vector",
    k: int = 5,
    pivots: int = 32,
    sample: int = 4096,
    candidates_per_block: int = 8192,
    queries_per_block: int = 1024,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all other rows for every query.

    ``vector`` holds integers whose products sum to less than 2^63. Shorter vectors count as
    filled up with zeros. Rows with a null key or vector take no part. A row is no candidate
    for its own key; a query key that repeats asks once, with its smallest vector, while
    repeated candidates each count. Pivots are chosen from ``sample`` rows (the smallest
    hashes); they decide the speed only.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(key).alias("id"), F.col(vector).cast("array<bigint>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where("id is not null and v is not null")
    picked = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    chosen = choose_pivots(matrix(picked.column("v")), pivots)

    def add_table(batches):
        for batch in batches:
            own = matrix(pa.chunked_array([batch.column("v")]))
            table = distances(own, chosen) if len(chosen) else np.zeros((len(own), 0))
            lists = pa.ListArray.from_arrays(
                np.arange(len(own) + 1, dtype="i4") * table.shape[1], pa.array(table.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["id", "v", "asks", "table"])

    path, seen = new_path(spark, "pivot-table"), Observation()
    tabled = rows.mapInArrow(add_table, "id bigint, v array<bigint>, asks boolean, table array<double>")
    tabled.observe(seen, F.count("*").alias("n"), F.count_if("asks").alias("asked")).write.parquet(path)
    counted = seen.get
    blocks = max(1, math.ceil((counted.get("n") or 0) / candidates_per_block))
    query_blocks = max(1, math.ceil((counted.get("asked") or 0) / queries_per_block))
    stored = spark.read.schema("id bigint, v array<bigint>, asks boolean, table array<double>").parquet(path)

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("id", F.hash("v")), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = stored.where("asks").groupBy("id").agg(F.min(F.struct("v", "table")).alias("s")).select("id", "s.*")
    left = queries.withColumn("qb", block(query_blocks)).withColumn("cb", every(blocks))
    right = stored.drop("asks").withColumn("cb", block(blocks)).withColumn("qb", every(query_blocks))

    def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
        q, x = matrix(asked.column("v")), matrix(held.column("v"))
        width = max(q.shape[1], x.shape[1])
        q, x = widened(q, width), widened(x, width)
        q_table, table = matrix(asked.column("table")), matrix(held.column("table"))
        norms = (x.astype("f8") ** 2).sum(1)
        ids = held.column("id").to_numpy()
        # products are exact in floating point below 2^53, and faster
        small = width * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2**53
        values = x.astype("f8") if small else x
        out = []
        for i, own_id in enumerate(asked.column("id").to_pylist()):
            vector_i = q[i].astype(values.dtype)
            near, scores = best(vector_i, own_id, q_table[i], ids, values, norms, table, k)
            out.append((np.full(len(near), own_id), near, scores.astype("i8")))
        columns = [np.concatenate(c).astype("i8") if c else np.empty(0, "i8") for c in zip(*out)] or [np.empty(0, "i8")] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))

    found = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInArrow(compare, "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
