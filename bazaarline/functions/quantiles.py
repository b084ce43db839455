"""Exact interpolated quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one task. Here a sketch
first brackets each wanted rank; one pass then counts what lies below a bracket
(map-side, to one row) and keeps only the values inside it, about 2 * MARGIN of
a group. Equal-width classes of the bracket narrow these to the class that holds
the rank, and only the values of that class are put in order.

The sketch's rank error is at most 1 / ACCURACY of the group, so in a group of
more than SMALL rows the bracket holds the wanted ranks and the result is exact:
(MARGIN - 1 / ACCURACY) * SMALL is more than the two ranks that rounding can take.
A bracket that missed a rank all the same raises an error. The keys and values are
staged first, so what they are made from is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .staging import stage

MARGIN = 0.002
ACCURACY = 2000
SMALL = 2000  # groups up to this size are ordered whole
CLASSES = 1024


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add one row of group figures to each row; a missing key has no group.

    Without keys ``stats`` is a single row, read through scalar subqueries.
    """
    keys = list(keys)
    extra = [c for c in stats.columns if c not in keys]
    if not keys:
        return df.select("*", *[stats.select(c).scalar().alias(c) for c in extra])
    joined = df.join(stats, keys, how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*df.columns)
    return joined.select(*df.columns, *extra)


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], staged: bool = False
) -> DataFrame:
    """One row per group: the keys and a column per name in ``probs``.

    ``staged`` says that ``df`` is a stored table, cheap to read again.
    """
    keys = list(keys)
    names, points = list(probs), [float(p) for p in probs.values()]
    rows = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .dropna(subset=keys or None)
    )
    if not staged:
        rows = stage(rows, "values")
    bounds = [max(p - MARGIN, 0.0) for p in points] + [min(p + MARGIN, 1.0) for p in points]
    sketch = stage(
        rows.groupBy(*keys).agg(
            F.count("_v").alias("_n"),
            F.percentile_approx("_v", bounds, ACCURACY).alias("_b"),
            F.min("_v").alias("_min"),
            F.max("_v").alias("_max"),
        ),
        "sketch",
    )
    k = len(points)

    def mark(i: int):
        low = (F.col("_n") <= SMALL) | F.lit(points[i] <= MARGIN)
        high = (F.col("_n") <= SMALL) | F.lit(points[i] >= 1 - MARGIN)
        return F.struct(
            F.lit(i).alias("i"),
            (F.lit(points[i]) * (F.col("_n") - 1)).alias("h"),
            F.when(low, F.col("_min")).otherwise(F.col("_b")[i]).alias("lo"),
            F.when(high, F.col("_max")).otherwise(F.col("_b")[k + i]).alias("hi"),
        )

    brackets = sketch.select(*keys, F.array(*[mark(i) for i in range(k)]).alias("_marks"))
    value, low = F.col("_v"), F.col("_m.lo")
    width = F.greatest(F.col("_m.hi") - low, F.lit(1e-300))
    place = F.least(F.floor((value - low) / width * CLASSES), F.lit(CLASSES - 1))
    inside = value >= low
    # (group, mark, -1, null) counts the rows below a bracket, the others those on a value.
    counted = (
        attach(rows, brackets, keys)
        .select(*keys, "_v", F.explode("_marks").alias("_m"))
        .where(value <= F.col("_m.hi"))
        .select(
            *keys,
            F.col("_m.i").alias("_i"),
            F.col("_m.h").alias("_h"),
            F.when(inside, place).otherwise(-1).alias("_k"),
            F.when(inside, value).alias("_v"),
        )
        .groupBy(*keys, "_i", "_h", "_k", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = lambda n, *by: F.sum(n).over(
        W.partitionBy(*keys, *by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, 0)
    )
    classes = (
        counted.groupBy(*keys, "_i", "_h", "_k")
        .agg(F.sum("_c").alias("_w"))
        .withColumn("_upto", upto("_w", "_i", "_k"))
        .withColumn("_before", F.col("_upto") - F.col("_w"))
        .where((F.col("_k") >= 0) & (F.col("_upto") > F.floor("_h")) & (F.col("_before") <= F.ceil("_h")))
        .select(*keys, "_i", "_k", "_before")
    )
    ranked = (
        counted.join(classes, [*keys, "_i", "_k"])
        .withColumn("_upto", F.col("_before") + upto("_c", "_i", "_k", "_v"))
        .withColumn("_from", F.col("_upto") - F.col("_c"))
    )

    def at(rank: Column, i: int) -> Column:
        hit = (F.col("_i") == i) & (F.col("_from") <= rank) & (rank < F.col("_upto"))
        return F.min(F.when(hit, F.col("_v")))

    def interpolated(i: int) -> Column:
        low, high = at(F.floor("_h"), i), at(F.ceil("_h"), i)
        part = F.max(F.when(F.col("_i") == i, F.col("_h") - F.floor("_h")))
        return low + (high - low) * part

    figures = ranked.groupBy(*keys).agg(*[interpolated(i).alias(names[i]) for i in range(k)])
    found = attach(sketch.select(*keys, "_n"), figures, keys)

    def checked(name: str) -> Column:
        missed = F.raise_error(F.lit(f"the bracket of {name} missed its rank"))
        return F.when((F.col("_n") > 0) & F.col(name).isNull(), missed).otherwise(F.col(name))

    return found.select(*keys, *[checked(n).alias(n) for n in names])
