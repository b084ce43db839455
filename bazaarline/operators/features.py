"""Time-series features of a panel.

A panel has one row per (product, region, date), so a series is as long as its
calendar, not as the raw data; all windows over a series share one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from ..functions.calendar import add_temporal_features
from ..functions.scalars import known, present, ratio
from ..sources.validate import require_columns

GROUP = ["product", "region"]
LAGS = (1, 2, 3, 6, 12)
WINDOWS = (3, 6)
CHANGES = (1, 3, 12)
SEQUENCE_FEATURES = [
    "month_sin", "month_cos", "is_ramadan", "is_holiday",
    "pct_change_1m", "pct_change_12m", "price_vs_national",
]


def over_time(keys: Sequence[str] = GROUP, order: Sequence[str] = ("date",)) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(*order)


def last_rows(n: int, keys: Sequence[str] = GROUP, order: Sequence[str] = ("date",)) -> WindowSpec:
    return over_time(keys, order).rowsBetween(-(n - 1), 0)


def lag_features(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    return df.withColumns({f"lag_price_{k}m": F.lag("price", k).over(over_time()) for k in lags})


def rolling_features(df: DataFrame, windows: Sequence[int] = WINDOWS) -> DataFrame:
    columns: dict[str, Column] = {}
    for n in windows:
        rows = last_rows(n)
        columns[f"rolling_{n}m_mean"] = F.avg("price").over(rows)
        columns[f"rolling_{n}m_std"] = F.coalesce(F.stddev_samp("price").over(rows), F.lit(0.0))
        columns[f"rolling_{n}m_min"] = F.min("price").over(rows)
        columns[f"rolling_{n}m_max"] = F.max("price").over(rows)
    return df.withColumns(columns)


def pct_change_features(df: DataFrame, steps: Sequence[int] = CHANGES) -> DataFrame:
    """Change in percent against k rows before; a missing price reads as the last known."""
    so_far = over_time().rowsBetween(W.unboundedPreceding, 0)
    held = df.withColumn("_held", F.last("price", ignorenulls=True).over(so_far))
    change = lambda k: (ratio(F.col("_held"), F.lag("_held", k).over(over_time())) - 1) * 100
    return held.withColumns({f"pct_change_{k}m": change(k) for k in steps}).drop("_held")


def price_vs_national(df: DataFrame) -> DataFrame:
    """Price over the mean price of all regions on that date.

    In a panel such a group has one row per region, so a window reads the panel once.
    """
    known_key = F.col("product").isNotNull() & F.col("date").isNotNull()
    national = F.when(known_key, F.avg("price").over(W.partitionBy("product", "date")))
    return df.withColumn("price_vs_national", ratio(F.col("price"), national))



def _scaler(method: str, per: Callable[[Column], Column]) -> tuple[Column, Column]:
    """What to subtract and divide by; ``per`` turns an aggregate into a column."""
    price = F.col("price")
    if method == "standard":
        centre, spread = per(F.avg(price)), per(F.stddev_pop(price))
    elif method == "robust":
        quartile = lambda p: per(F.percentile(price, F.lit(p)))
        centre, spread = quartile(0.5), quartile(0.75) - quartile(0.25)
    else:
        centre, spread = per(F.min(price)), per(F.max(price)) - per(F.min(price))
    return centre, F.when(spread == 0, 1.0).otherwise(spread)


def scaler_parameters(df: DataFrame, method: str = "minmax") -> DataFrame:
    """One row per series: ``centre`` and ``spread`` (1 where the spread is zero)."""
    centre, spread = _scaler(method, lambda c: c)
    return df.groupBy(*GROUP).agg(centre.alias("centre"), spread.alias("spread"))


def normalise(df: DataFrame, method: str = "minmax") -> DataFrame:
    """``price_norm`` by series; an unknown method means min-max."""
    series = W.partitionBy(*GROUP)
    centre, spread = _scaler(method, lambda c: c.over(series))
    return df.withColumn("price_norm", (F.col("price") - centre) / spread)


def inverse_normalise(
    df: DataFrame, parameters: DataFrame, value: str = "price_norm", out: str = "price"
) -> DataFrame:
    """Back to prices. Rows of a series without parameters raise KeyError."""
    unknown = df.select(*GROUP).distinct().join(parameters, GROUP, "left_anti").head(1)
    if unknown:
        raise KeyError(f"No scaler found for {tuple(unknown[0])}.")
    joined = df.join(parameters, GROUP)
    price = F.col(value) * F.col("spread") + F.col("centre")
    return joined.withColumn(out, price).drop("centre", "spread")


def build_features(df: DataFrame, method: str = "minmax") -> DataFrame:
    """Calendar, lags, rolling figures, changes, national ratio, normalised price."""
    require_columns(df, ["date", "product", "region", "price"])
    return (
        df.withColumn("price", known(df, "price"))
        .transform(price_vs_national)
        .transform(lag_features)
        .transform(rolling_features)
        .transform(pct_change_features)
        .transform(normalise, method)
        .transform(add_temporal_features)
    )


def build_sequences(
    features: DataFrame,
    length: int = 60,
    target: str = "price_norm",
    columns: Sequence[str] = SEQUENCE_FEATURES,
) -> DataFrame:
    """Every window of ``length`` rows as ``x`` (steps of features), the next target as ``y``."""
    names = [target, *present(features, columns)]
    step = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])
    numbered = features.select(
        *GROUP, "date", step.alias("_step"), F.row_number().over(over_time()).alias("_row")
    )
    back = over_time().rowsBetween(-length, -1)
    return (
        numbered.withColumn("x", F.collect_list("_step").over(back))
        .where(F.col("_row") > length)
        .select(*GROUP, "date", "x", F.col("_step")[0].alias("y"))
    )


def simple_features(df: DataFrame) -> DataFrame:
    """The board's own three: change on 1 and 12 rows, rolling mean of 3."""
    return pct_change_features(df, (1, 12)).withColumn("rolling_3m", F.avg("price").over(last_rows(3)))
