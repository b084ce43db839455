"""Mean RBF similarity of a row to its group.

The similarity is the decision function of a one-class SVM with nu = 1 (Schölkopf
et al. 2001): the mean of exp(-gamma |x - y|²) over the rows y of the group. With
nu < 1 the mean is weighted: ``one_class`` solves the dual problem of each group,
min ½ aᵀKa with 0 <= a <= 1 / (nu n) and weights that add up to 1. It is meant for series of a panel, which are as long as their calendar. A fitted group
is one row with its distinct feature rows and their counts, and scoring folds
over them in one column expression. Longer groups raise an error: nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.staging import spread

LONGEST = 36_525  # distinct rows of a series: a hundred years of days
#: How far below the offset a row must be to count as outside: rows on the boundary are
#: within the solver's tolerance of it.
MARGIN = 1e-5
#: Distinct rows up to which a group's kernel matrix is held (32 MB); beyond, its columns
#: are made when they are needed.
WHOLE = 2048


def one_class(x: np.ndarray, n: np.ndarray, nu: float, gamma: float, tolerance: float = 1e-7) -> tuple[np.ndarray, float]:
    """Weights of distinct rows ``x`` that stand ``n`` times, and the offset rho.

    Sequential minimal optimisation: of the weights that can grow and those that can
    shrink, the pair that breaks the optimality conditions most is moved to its best
    place, until none breaks them by more than ``tolerance``. Ties go to the first row.
    """
    size = len(x)
    bound = n / (nu * n.sum())
    squares = (x * x).sum(1)

    def columns(at: np.ndarray) -> np.ndarray:
        apart = squares[at, None] + squares[None, :] - 2 * x[at] @ x.T
        return np.exp(-gamma * np.maximum(apart, 0.0))

    whole = columns(np.arange(size)) if size <= WHOLE else None
    column = (lambda i: whole[i]) if whole is not None else (lambda i: columns(np.array([i]))[0])
    weight = np.minimum(bound, np.maximum(1.0 - (np.cumsum(bound) - bound), 0.0))
    force = np.zeros(size)
    for at in range(0, size, WHOLE):
        part = np.arange(at, min(at + WHOLE, size))
        part = part[weight[part] > 0]
        force += weight[part] @ (whole[part] if whole is not None else columns(part))
    tiny = 1e-12
    for _ in range(200 * size + 10_000):
        can_grow, can_shrink = weight < bound - tiny, weight > tiny
        if not can_grow.any():
            break
        i = int(np.argmin(np.where(can_grow, force, np.inf)))
        j = int(np.argmax(np.where(can_shrink, force, -np.inf)))
        gap = force[j] - force[i]
        if gap <= tolerance:
            break
        own, other = column(i), column(j)
        step = min(gap / max(2.0 - 2.0 * own[j], tiny), bound[i] - weight[i], weight[j])
        weight[i] += step
        weight[j] -= step
        force += step * (own - other)
    free = (weight > tiny) & (weight < bound - tiny)
    if free.any():
        rho = float(force[free].mean())
    else:
        low = force[weight > tiny].max()
        high = force[weight <= tiny].min() if (weight <= tiny).any() else low
        rho = float((low + high) / 2)
    return np.where(weight > tiny, weight, 0.0), rho


def solve_boundary(fitted: DataFrame, dims: int, nu: float, gamma: float | None = None) -> DataFrame:
    """``fitted`` with the weights of the dual problem for ``n`` in ``boundary``, rows of
    weight 0 left out, and ``offset``: a row is outside where its similarity is below it.

    A row with a missing feature has no place in the problem and is left out.
    """
    if not 0 < nu <= 1:
        raise ValueError("nu is a share above 0, at most 1")
    gamma = 1.0 / dims if gamma is None else gamma
    point = "array<struct<x:array<double>,n:double>>"

    def run(groups: pa.Array) -> pa.Array:
        out = []
        for group in groups.to_pylist():
            held = [(p["x"], p["n"]) for p in group or () if p["x"] is not None and None not in p["x"]]
            if not held:
                out.append({"points": [], "offset": None})
                continue
            x, n = np.array([p for p, _ in held], float), np.array([c for _, c in held], float)
            weight, rho = one_class(x, n, nu, gamma)
            out.append({"points": [{"x": p, "n": w} for (p, _), w in zip(held, weight.tolist()) if w > 0], "offset": rho})
        kind = pa.struct([("points", pa.list_(pa.struct([("x", pa.list_(pa.float64())), ("n", pa.float64())]))), ("offset", pa.float64())])
        return pa.array(out, kind)

    run.__annotations__ = {"groups": pa.Array, "return": pa.Array}
    solved = F.arrow_udf(run, f"struct<points:{point},offset:double>")(F.col("boundary").cast(point))
    kept = [c for c in fitted.columns if c != "boundary"]
    made = fitted.select(*kept, solved.alias("_solved"))
    return made.select(*kept, F.col("_solved.points").alias("boundary"), F.col("_solved.offset").alias("offset"))


def fit_boundary(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    longest: int = LONGEST,
    nu: float = 1.0,
    gamma: float | None = None,
) -> DataFrame:
    """One row per group: keys and ``boundary``, an array of (x, n).

    With ``nu`` < 1, n is a row's weight and there is an ``offset``; see ``solve_boundary``.
    """
    counted = df.groupBy(*keys, *features).agg(F.count(F.lit(1)).alias("_n"))
    point = F.struct(F.array(*features).alias("x"), F.col("_n").alias("n"))
    fitted = counted.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("boundary"))
    message = F.lit(f"a series has more than {longest} distinct rows: aggregate it to periods first")
    checked = F.when(F.size("boundary") > longest, F.raise_error(message)).otherwise(F.col("boundary"))
    fitted = fitted.withColumn("boundary", checked)
    if nu == 1:
        return fitted
    # one problem per row, each costly: not by file size, all tasks take their share
    return solve_boundary(spread(fitted, *keys), len(features), nu, gamma)


def similarity(x: Column, boundary: Column, dims: int, gamma: float | None = None) -> Column:
    """Mean kernel of a feature array with the rows of a fitted group."""
    gamma = 1.0 / dims if gamma is None else gamma

    def term(total: Column, point: Column) -> Column:
        steps = [F.get(x, F.lit(i)) - F.get(point["x"], F.lit(i)) for i in range(dims)]
        apart = reduce(lambda a, b: a + b, [d * d for d in steps])
        return total + point["n"] * F.exp(-gamma * apart)

    size = F.aggregate(boundary, F.lit(0.0), lambda total, point: total + point["n"])
    return F.aggregate(boundary, F.lit(0.0), term) / size


def add_similarity(
    df: DataFrame, boundary: DataFrame, keys: Sequence[str], features: Sequence[str], out: str, gamma: float | None = None
) -> DataFrame:
    """Adds the similarity of every row to its group; missing for an unknown group."""
    points = boundary.select(*keys, F.col("boundary").alias("_points"))
    joined = df.join(points, list(keys), "left").withColumn("_x", F.array(*features))
    mean = similarity(F.col("_x"), F.col("_points"), len(features), gamma)
    return joined.select(*df.columns, mean.alias(out))
