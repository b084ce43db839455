"""Correlations of many products by blocked sums.

The plain report joins a date's products with each other, row by row. Here products are dealt to
blocks and dates to chunks; a task holds one chunk's date-by-product arrays of two blocks
and multiplies them as matrices. That gives n, Σa, Σb, Σa², Σb² and Σab of all pairs of
those blocks at once, which are added up over the chunks. No date, product or pair of rows
has to be in one task, and a task's memory is bounded by the block and the chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.staging import spread, stage

#: What is summed over dates for each pair of products (a, b).
SUMS = ("present", "n", "a", "b", "aa", "bb", "ab")


def dealt(means: DataFrame, block: int) -> DataFrame:
    """``product, block, place, centre``: places count from 0 in a block.

    ``centre`` is the product's mean: sums of deviations keep their digits.
    """
    centres = stage(means.groupBy("product").agg(F.avg("price").alias("centre")), "products")
    blocks = max(1, -(-centres.count() // block))
    placed = centres.withColumn("block", F.pmod(F.xxhash64("product"), F.lit(blocks)).cast("int"))
    order = F.row_number().over(W.partitionBy("block").orderBy("product"))
    return stage(placed.withColumn("place", order - 1).withColumn("blocks", F.lit(blocks)), "dealt")


def pair_sums(lines: DataFrame) -> DataFrame:
    """``low, high, width_low, width_high`` and the sums of a chunk's pairs, row by row."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high, _ = (k.as_py() for k in key)
        sides = []
        dates = {d: i for i, d in enumerate(sorted(set(table.column("date").to_pylist())))}
        for block in (low, high):
            part = table.filter(pc.equal(table.column("block"), block))
            width = part.column("width")[0].as_py() if part.num_rows else 0
            value, here = np.full((len(dates), width), np.nan), np.zeros((len(dates), width))
            rows = zip(part.column("date").to_pylist(), part.column("places").to_pylist(), part.column("prices").to_pylist())
            for date, places, prices in rows:
                value[dates[date], places] = [np.nan if p is None else p for p in prices]
                here[dates[date], places] = 1.0
            known = ~np.isnan(value)
            sides.append((here, known.astype(float), np.where(known, value, 0.0)))
        (here_a, known_a, a), (here_b, known_b, b) = sides
        made = [here_a.T @ here_b, known_a.T @ known_b, a.T @ known_b, known_a.T @ b, (a * a).T @ known_b, known_a.T @ (b * b), a.T @ b]
        values = [[low], [high], [a.shape[1]], [b.shape[1]], *([m.astype("<f8").tobytes()] for m in made)]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * len(SUMS)]
        names = ["low", "high", "width_low", "width_high", *SUMS]
        return pa.table([pa.array(v, t) for v, t in zip(values, types)], names=names)

    schema = "low int, high int, width_low int, width_high int, " + ", ".join(f"{s} binary" for s in SUMS)
    return lines.groupBy("low", "high", "chunk").applyInArrow(run, schema)


def added(parts: DataFrame) -> DataFrame:
    """Correlations by place from the chunks' sums: ``low, high, place_a, place_b, …``.

    A task adds up the arrays of one pair of blocks as they stream by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sums = None
        for batch in batches:
            for row in batch.to_pylist():
                own = (row["low"], row["high"], row["width_low"], row["width_high"])
                arrays = [np.frombuffer(row[s], "<f8") for s in SUMS]
                if own == key:
                    sums = [s + a for s, a in zip(sums, arrays)]
                    continue
                if key is not None:
                    yield figures(key, sums)
                key, sums = own, arrays
        if key is not None:
            yield figures(key, sums)

    schema = "low int, high int, place_a int, place_b int, correlation double, n_dates bigint"
    placed = spread(parts, "low", "high").sortWithinPartitions("low", "high")
    return placed.mapInArrow(run, schema)


def figures(key: tuple[int, int, int, int], sums: list[np.ndarray]) -> pa.RecordBatch:
    low, high, wide_low, wide_high = key
    present, n, a, b, aa, bb, ab = (s.reshape(wide_low, wide_high) for s in sums)
    place = np.argwhere(present > 0).astype("i4")
    if low == high:
        place = place[place[:, 0] > place[:, 1]]  # each pair once
    at = tuple(place.T)
    n, a, b, aa, bb, ab = (s[at] for s in (n, a, b, aa, bb, ab))
    spread_a, spread_b = n * aa - a * a, n * bb - b * b
    # a deviation within rounding of the sums is none
    flat = (spread_a <= 1e-12 * n * aa) | (spread_b <= 1e-12 * n * bb) | (n < 2)
    with np.errstate(all="ignore"):
        value = (n * ab - a * b) / np.sqrt(spread_a * spread_b)
    names = ["low", "high", "place_a", "place_b", "correlation", "n_dates"]
    columns = [np.full(len(place), low, "i4"), np.full(len(place), high, "i4"), place[:, 0], place[:, 1]]
    arrays = [*map(pa.array, columns), pa.array(value, mask=flat), pa.array(n.astype("i8"))]
    return pa.RecordBatch.from_arrays(arrays, names)


def product_correlation(df: DataFrame, block: int = 256, dates: int = 512) -> DataFrame:
    """``product_a, product_b, correlation, n_dates`` as ``analytics.product_correlation``.

    A row per pair of products with a common date, the greater name first; ``n_dates``
    counts the dates with both prices, and the correlation is missing under two of them or
    where a price doesn't vary. Rows without a date or product are left out.
    """
    known = df.dropna(subset=["date", "product"])
    means = stage(known.groupBy("date", "product").agg(F.avg("price").alias("price")), "means")
    products = dealt(means, block)
    days = means.agg(F.approx_count_distinct("date")).first()[0]
    chunks = max(1, -(-days // dates))
    widths = products.groupBy("block").agg(F.count(F.lit(1)).cast("int").alias("width"))
    cells = means.join(products, "product").withColumn("price", F.col("price") - F.col("centre"))
    point = F.collect_list(F.struct("place", "price")).alias("_points")
    lines = cells.groupBy("date", "block", "blocks").agg(point).join(widths, "block")
    chunk = F.pmod(F.xxhash64("date"), F.lit(chunks))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    lines = lines.select(
        "date", "block", "width", chunk.alias("chunk"),
        F.col("_points.place").alias("places"), F.col("_points.price").alias("prices"), partner.alias("other"),
    )
    lines = lines.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    pairs = stage(added(pair_sums(lines)), "pairs")
    name = products.select("block", "place", "product")
    first = name.toDF("low", "place_a", "_a")
    second = name.toDF("high", "place_b", "_b")
    named = pairs.join(first, ["low", "place_a"]).join(second, ["high", "place_b"])
    return named.select(
        F.greatest("_a", "_b").alias("product_a"), F.least("_a", "_b").alias("product_b"), "correlation", "n_dates"
    )
