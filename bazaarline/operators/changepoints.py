"""A trend that bends: ridge regression of hinges and yearly waves, all series at once.

A series is ``level + slope * u + sum of changes * hinges(u) + waves + events``, with u its
time from 0 to 1 and hinges at evenly spaced points of its first 80 %. In the
multiplicative mode (the usual one) that is the logarithm of the price, so
seasons and events are factors. Slope changes and waves are shrunk by ridge
penalties; level and slope are free.

The normal equations of a series are plain sums (partial aggregates: no row of a series
has to meet another), and a Cholesky factor of them is folded in array
functions. One row per series holds the model.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import is_holiday, is_ramadan
from ..functions.scalars import ratio
from ..functions.staging import stage
from .features import GROUP
from .forecast import MIN_ROWS, add_future, fit_seasonal_trend, holdout_split, month_index, quantile_of

#: Share of a series in which its slope may change.
REACH = 0.8


@dataclass(frozen=True)
class Bends:
    """Shape of the model. ``changes`` hinges and ``harmonics`` waves per year."""

    changes: int = 8
    harmonics: int = 3
    multiplicative: bool = True
    events: bool = False
    change_penalty: float = 0.1
    season_penalty: float = 0.1

    @property
    def places(self) -> list[float]:
        return [REACH * (k + 1) / self.changes for k in range(self.changes)]

    @property
    def penalties(self) -> list[float]:
        seasonal = 2 * self.harmonics + (2 if self.events else 0)
        # all prices in one month say nothing of a slope: it is 0 then
        return [0.0, 1e-8] + [self.change_penalty] * self.changes + [self.season_penalty] * seasonal

    def terms(self, day: Column, u: Column) -> list[Column]:
        """The regressors of a day at time ``u``."""
        made = [F.lit(1.0), u]
        made += [F.greatest(u - F.lit(c), F.lit(0.0)) for c in self.places]
        for h in range(1, self.harmonics + 1):
            angle = (F.month(day) - 1) * F.lit(2 * math.pi * h / 12)
            made += [F.sin(angle), F.cos(angle)]
        if self.events:
            made += [is_ramadan(day).cast("double"), is_holiday(day).cast("double")]
        return made


# ---- linear algebra on arrays --------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays; of the shorter one's length."""
    n = F.least(F.size(a), F.size(b))
    products = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cholesky(rows: Column) -> Column:
    """Rows of the lower factor of a positive definite matrix; row i has i + 1 numbers.

    ``rows`` is the matrix as an array of arrays, of which only the lower half is read.
    """

    def next_row(factor: Column, row: Column) -> Column:
        def entry(made: Column, above: Column) -> Column:
            at = F.size(made)
            return F.concat(made, F.array((F.get(row, at) - dot(made, above)) / F.get(above, at)))

        head = F.aggregate(factor, F.array().cast("array<double>"), entry)
        last = F.sqrt(F.get(row, F.size(head)) - dot(head, head))
        return F.concat(factor, F.array(F.concat(head, F.array(last))))

    return F.aggregate(rows, F.array().cast("array<array<double>>"), next_row)


def solve(factor: Column, right: Column) -> Column:
    """x with (factor factorᵀ) x = right, from the factor's rows."""

    def forward(made: Column, row: Column) -> Column:
        at = F.size(made)
        return F.concat(made, F.array((F.get(right, at) - dot(made, row)) / F.get(row, at)))

    half = F.aggregate(factor, F.array().cast("array<double>"), forward)

    def backward(made: Column, row: Column) -> Column:
        """``made`` holds the numbers that come after this row's."""
        at = F.size(row) - 1
        below = F.transform(F.slice(factor, at + 2, F.size(made)), lambda lower: F.get(lower, at))
        return F.concat(F.array((F.get(half, at) - dot(below, made)) / F.get(row, at)), made)

    return F.aggregate(F.reverse(factor), F.array().cast("array<double>"), backward)


# ---- the model -----------------------------------------------------------------


def observed(df: DataFrame, bends: Bends) -> DataFrame:
    """Rows that can be fitted, with the value that is fitted."""
    price = F.col("price")
    usable = price.isNotNull() & ~F.isnan(price) & (price > 0 if bends.multiplicative else F.lit(True))
    value = F.log(price) if bends.multiplicative else price
    return df.where(usable).select(*GROUP, "date", month_index(F.col("date")).alias("_m"), value.alias("_y"))


def fit_changepoints(df: DataFrame, bends: Bends = Bends(), min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per series of at least ``min_rows`` known prices.

    ``t0`` and ``span`` (months), ``beta`` (the coefficients in the order of ``Bends.terms``),
    ``scale`` (what values were divided by), ``sigma`` (residual deviation, in values),
    ``last_date`` and ``fit_rows``.
    """
    rows = stage(observed(df, bends), "observed")
    size = F.lit(1.0) if bends.multiplicative else F.max(F.abs("_y"))
    size = F.when(size > 0, size).otherwise(1.0)
    spans = rows.groupBy(*GROUP).agg(
        F.min("_m").alias("t0"),
        (F.max("_m") - F.min("_m")).alias("span"),
        size.alias("scale"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("fit_rows"),
    )
    spans = stage(spans.where(F.col("fit_rows") >= min_rows), "spans")
    timed = rows.join(spans.select(*GROUP, "t0", "span", "scale"), GROUP)
    terms = bends.terms(F.col("date"), elapsed(F.col("_m")))
    x = timed.select(*GROUP, (F.col("_y") / F.col("scale")).alias("_y"), *[t.alias(f"_x{i}") for i, t in enumerate(terms)])
    p = len(terms)
    products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_s{i}_{j}") for i in range(p) for j in range(i + 1)]
    rights = [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"_r{i}") for i in range(p)]
    sums = x.groupBy(*GROUP).agg(*products, *rights)
    lower = lambda i, j: F.col(f"_s{i}_{j}") + (F.lit(bends.penalties[i]) if i == j else F.lit(0.0))
    equations = sums.select(
        *GROUP,
        F.array(*[F.array(*[lower(i, j) for j in range(i + 1)]) for i in range(p)]).alias("_matrix"),
        F.array(*[F.col(f"_r{i}") for i in range(p)]).alias("_right"),
    )
    factored = equations.withColumn("_factor", cholesky(F.col("_matrix")))
    solved = factored.select(*GROUP, solve(F.col("_factor"), F.col("_right")).alias("beta"))
    model = stage(spans.join(solved, GROUP), "bends")
    fitted = rows.join(model.select(*GROUP, "t0", "span", "scale", "beta"), GROUP)
    rest = F.col("_y") - F.col("scale") * curve(bends, F.col("date"), elapsed(F.col("_m")))
    sigma = fitted.groupBy(*GROUP).agg(F.stddev_samp(rest).alias("sigma"))
    return model.join(sigma, GROUP)


def elapsed(month: Column) -> Column:
    """Time in a series: 0 at its first month, 1 at its last, more beyond it."""
    return F.coalesce(ratio((month - F.col("t0")).cast("double"), F.col("span")), F.lit(0.0))


def curve(bends: Bends, day: Column, u: Column) -> Column:
    parts = [F.get("beta", F.lit(i)) * t for i, t in enumerate(bends.terms(day, u))]
    return sum(parts[1:], parts[0])


def predict_changepoints(
    model: DataFrame, bends: Bends = Bends(), horizon: int = 12, interval: float = 0.95
) -> DataFrame:
    """``yhat`` with bounds for the next months; the last slope goes on.

    The variance of a step is that of the residuals and that of slopes which may go on
    changing: as often as hinges in the past, each change Laplace-distributed with the
    past changes' mean size.
    """
    future = add_future(model, F.lit(horizon))
    value = F.col("scale") * curve(bends, F.col("ds"), elapsed(month_index(F.col("ds"))))
    step, span = F.col("step"), F.greatest(F.col("span"), F.lit(1))
    total = sum((F.abs(F.get("beta", F.lit(2 + k))) for k in range(bends.changes)), F.lit(0.0))
    size = F.col("scale") * total / (max(bends.changes, 1) * span)  # a change of slope, per month
    rate = bends.changes / (REACH * span)
    squares = step * (step + 1) * (2 * step + 1) / 6.0
    reach = quantile_of(interval) * F.sqrt(F.pow(F.coalesce("sigma", F.lit(0.0)), 2) + 2 * size * size * rate * squares)
    back = F.exp if bends.multiplicative else lambda v: v
    made = future.withColumns({"_v": value, "_reach": reach})
    return made.select(
        *GROUP, "step", "ds",
        back(F.col("_v")).alias("yhat"),
        back(F.col("_v") - F.col("_reach")).alias("yhat_lower"),
        back(F.col("_v") + F.col("_reach")).alias("yhat_upper"),
    )


def forecast_changepoints(
    df: DataFrame, horizon: int = 12, interval: float = 0.95, bends: Bends = Bends(), min_rows: int = MIN_ROWS
) -> DataFrame:
    """Months ahead of every series of at least ``min_rows`` known prices."""
    return predict_changepoints(fit_changepoints(df, bends, min_rows), bends, horizon, interval)


def trend_changes(model: DataFrame, bends: Bends = Bends()) -> DataFrame:
    """A row per series and hinge: its month, the change of slope there and the slope after it.

    Slopes are per month: of the logarithm in the multiplicative mode, else of the price.
    """
    beta = lambda i: F.get("beta", F.lit(i))
    per = F.col("scale") / F.greatest(F.col("span"), F.lit(1))
    points = []
    for k, place in enumerate(bends.places):
        after = sum((beta(2 + j) for j in range(k + 1)), beta(1))
        month = (F.col("t0") + F.floor(F.col("span") * F.lit(place))).cast("int")
        start = F.make_date(F.floor((month - 1) / 12).cast("int"), F.pmod(month - 1, F.lit(12)) + 1, F.lit(1))
        points.append(F.struct(F.lit(k + 1).alias("number"), start.alias("month"), (per * beta(2 + k)).alias("change"), (per * after).alias("slope")))
    return model.select(*GROUP, F.inline(F.array(*points)))


def evaluate_changepoints(df: DataFrame, bends: Bends = Bends(), share: float = 0.8, min_rows: int = MIN_ROWS) -> DataFrame:
    """Holdout error of the bent trend and of the straight line, a row per series.

    Both are fitted to the first ``share`` of a series' rows and judged on the rest.
    """
    split = stage(holdout_split(df.where("price is not null").select(*GROUP, "date", "price"), share), "split")
    train, test = (split.where(F.col("part") == part).drop("part", "step") for part in ("train", "test"))
    bent, line = fit_changepoints(train, bends, min_rows), fit_seasonal_trend(train)
    judged = test.withColumn("_m", month_index(F.col("date"))).join(bent, GROUP)
    value = F.col("scale") * curve(bends, F.col("date"), elapsed(F.col("_m")))
    judged = judged.select(*GROUP, "date", "price", "_m", (F.exp(value) if bends.multiplicative else value).alias("_bent"))
    straight = line.select(*GROUP, F.col("t0").alias("_t0"), "intercept", "slope", "season")
    both = judged.join(straight, GROUP)
    trend = F.col("intercept") + F.col("slope") * (F.col("_m") - F.col("_t0"))
    both = both.withColumn("_line", trend * F.get("season", F.month("date") - 1))
    error = lambda c: F.avg(F.abs(F.col(c) - F.col("price")))
    return both.groupBy(*GROUP).agg(
        error("_bent").alias("mae_bent"), error("_line").alias("mae_line"), F.count(F.lit(1)).alias("n_test")
    )
