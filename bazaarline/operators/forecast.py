"""Forecasts of every series at once, from sums per series.

Each model is a few aggregates per (product, region); its parameters form a
table, and the horizon is an ``explode`` of a short sequence.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import is_holiday, is_ramadan
from ..functions.scalars import ratio
from ..functions.staging import stage
from .features import GROUP, over_time

MIN_ROWS = 24
# Rounded normal quantiles of the two usual interval widths.
Z = {0.95: 1.96, 0.90: 1.64}


def quantile_of(interval: float) -> float:
    """Deviations on either side that hold this share of a normal distribution."""
    if not 0 < interval < 1:
        raise ValueError("an interval is a share between 0 and 1")
    return Z.get(interval) or NormalDist().inv_cdf((1 + interval) / 2)


def month_index(day: Column) -> Column:
    """Months since year 0, so that gaps keep their length."""
    return F.year(day) * 12 + F.month(day)


def fit_gate(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of the series that are long enough to fit."""
    size = F.count(F.lit(1)).over(W.partitionBy(*GROUP))
    return df.withColumn("_n", size).where(F.col("_n") >= min_rows).drop("_n")


def skipped_series(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Series too short to fit, with their number of rows."""
    return (
        df.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") < min_rows)
    )


def future_calendar(df: DataFrame, horizon: int = 12) -> DataFrame:
    """The next ``horizon`` month starts of each series, numbered by ``step``."""
    if not 1 <= horizon <= 24:
        raise ValueError("horizon must be between 1 and 24")
    last = df.groupBy(*GROUP).agg(F.max("date").alias("last_date"))
    return add_future(last, F.lit(horizon)).drop("last_date")


def add_future(series: DataFrame, horizon: Column) -> DataFrame:
    start = F.trunc("last_date", "month")
    return series.withColumn("step", F.explode(F.sequence(F.lit(1), horizon))).withColumn(
        "ds", F.add_months(start, F.col("step"))
    )


def fit_seasonal_trend(df: DataFrame, events: bool = False) -> DataFrame:
    """Trend line, mean ratio to it per calendar month, and residual deviation.

    One row per series: intercept and slope on ``month_index``, ``season`` (an
    array of twelve factors, missing months 1), ``sigma``, ``last_date`` and, with
    ``events``, the mean residual factor of months with Ramadan or a holiday.
    """
    series = W.partitionBy(*GROUP)
    t, y = month_index(F.col("date")) - F.col("_t0"), F.col("price")
    based = df.withColumn("_t0", F.min(month_index(F.col("date"))).over(series)).withColumn("_t", t)
    slope, intercept = F.regr_slope(y, F.col("_t")).over(series), F.regr_intercept(y, F.col("_t")).over(series)
    trended = based.withColumns(
        {"_b": F.coalesce(slope, F.lit(0.0)), "_a": F.coalesce(intercept, F.avg(y).over(series))}
    ).withColumn("_trend", F.col("_a") + F.col("_b") * F.col("_t"))
    month = W.partitionBy(*GROUP, F.month("date"))
    factor = F.coalesce(F.avg(ratio(y, F.col("_trend"))).over(month), F.lit(1.0))
    fitted = trended.withColumn("_factor", factor).withColumn("_fit", F.col("_trend") * F.col("_factor"))
    marks = {"ramadan": is_ramadan(F.col("date")), "holiday": is_holiday(F.col("date"))}
    effects = []
    for name, mark in marks.items():
        inside = F.avg(F.when(mark == 1, ratio(y, F.col("_fit"))))
        effects.append((F.coalesce(inside, F.lit(1.0)) if events else F.lit(1.0)).alias(f"{name}_effect"))
    at = lambda m: F.coalesce(F.max(F.when(F.month("date") == m, F.col("_factor"))), F.lit(1.0))
    return fitted.groupBy(*GROUP).agg(
        F.max("_t0").alias("t0"),
        F.max("_a").alias("intercept"),
        F.max("_b").alias("slope"),
        F.array(*[at(m) for m in range(1, 13)]).alias("season"),
        F.stddev_samp(y - F.col("_fit")).alias("sigma"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("fit_rows"),
        *effects,
    )


def predict_seasonal_trend(
    model: DataFrame, horizon: Column | int = 12, interval: float = 0.95, events: bool = False
) -> DataFrame:
    horizon = F.lit(horizon) if isinstance(horizon, int) else horizon
    future = add_future(model, horizon)
    trend = F.col("intercept") + F.col("slope") * (month_index(F.col("ds")) - F.col("t0"))
    yhat = trend * F.get("season", F.month("ds") - 1)
    if events:
        yhat = yhat * F.when(is_ramadan(F.col("ds")) == 1, F.col("ramadan_effect")).otherwise(1.0)
        yhat = yhat * F.when(is_holiday(F.col("ds")) == 1, F.col("holiday_effect")).otherwise(1.0)
    reach = quantile_of(interval) * F.coalesce(F.col("sigma"), F.lit(0.0))
    return future.withColumn("yhat", yhat).select(
        *GROUP, "step", "ds", "yhat",
        (F.col("yhat") - reach).alias("yhat_lower"),
        (F.col("yhat") + reach).alias("yhat_upper"),
    )


def forecast_seasonal_trend(
    df: DataFrame, horizon: int = 12, interval: float = 0.95, events: bool = False
) -> DataFrame:
    return predict_seasonal_trend(fit_seasonal_trend(fit_gate(df), events), horizon, interval, events)


def fit_autoregressive(df: DataFrame) -> DataFrame:
    """Price on the price one row before; a constant series repeats its last price."""
    paired = df.withColumn("_x", F.lag("price").over(over_time()))
    slope, intercept = F.regr_slope("price", "_x"), F.regr_intercept("price", "_x")
    clipped = F.greatest(F.least(slope, F.lit(0.999)), F.lit(-0.999))
    return paired.groupBy(*GROUP).agg(
        clipped.alias("phi"),
        ratio(intercept, 1 - clipped).alias("level"),
        F.max_by("price", "date").alias("last_price"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("fit_rows"),
    )


def predict_autoregressive(model: DataFrame, horizon: Column | int = 12) -> DataFrame:
    """The h-step forecast in closed form: level + phi^h (last - level)."""
    horizon = F.lit(horizon) if isinstance(horizon, int) else horizon
    power = F.pow(F.col("phi"), F.col("step"))
    ahead = F.col("level") + power * (F.col("last_price") - F.col("level"))
    return add_future(model, horizon).select(
        *GROUP, "step", "ds", F.coalesce(ahead, F.col("last_price")).alias("yhat")
    )


def forecast_autoregressive(df: DataFrame, horizon: int = 12) -> DataFrame:
    return predict_autoregressive(fit_autoregressive(fit_gate(df)), horizon)


def combine(
    trend: DataFrame, ar: DataFrame | None, trend_weight: float = 0.5, ar_weight: float = 0.5
) -> DataFrame:
    """Weighted mean of both forecasts; a missing one is replaced by the trend."""
    left = trend.withColumnRenamed("yhat", "trend_yhat")
    if ar is None:
        joined = left.withColumn("ar_yhat", F.col("trend_yhat"))
    else:
        right = ar.select(*GROUP, "step", F.col("yhat").alias("ar_yhat"))
        joined = left.join(right, [*GROUP, "step"], "left").withColumn(
            "ar_yhat", F.coalesce("ar_yhat", "trend_yhat")
        )
    mixed = trend_weight * F.col("trend_yhat") + ar_weight * F.col("ar_yhat")
    return joined.select(
        "ds", "trend_yhat", "ar_yhat", mixed.alias("ensemble_yhat"),
        "yhat_lower", "yhat_upper", *GROUP, "step",
    )


def forecast_ensemble(
    df: DataFrame,
    horizon: int = 12,
    trend_weight: float = 0.5,
    ar_weight: float = 0.5,
    interval: float = 0.95,
) -> DataFrame:
    """Both models from one staged panel, a row per series and month."""
    rows = stage(fit_gate(df.select(*GROUP, "date", "price")), "panel")
    trend = predict_seasonal_trend(fit_seasonal_trend(rows), horizon, interval)
    ar = predict_autoregressive(fit_autoregressive(rows), horizon) if ar_weight else None
    return combine(trend, ar, trend_weight, ar_weight)


def forecast_quadratic(
    df: DataFrame, horizon: int = 12, interval: float = 0.90, min_rows: int = 12
) -> DataFrame:
    """Second-degree least squares on the row number, never below 0.

    Normal equations of the centred row number from six sums per series.
    """
    n, x, y = F.count(F.lit(1)), F.col("_x"), F.col("price")
    series = W.partitionBy(*GROUP)
    numbered = fit_gate(df, min_rows).withColumn("_i", F.row_number().over(over_time()) - 1)
    centred = numbered.withColumn("_x", F.col("_i") - F.avg("_i").over(series))
    sums = centred.groupBy(*GROUP).agg(
        n.cast("double").alias("n"),
        F.sum(x**2).alias("s2"),
        F.sum(x**3).alias("s3"),
        F.sum(x**4).alias("s4"),
        F.sum(y).alias("t0"),
        F.sum(x * y).alias("t1"),
        F.sum(x**2 * y).alias("t2"),
        F.stddev_pop(y).alias("sigma"),
        F.max("date").alias("last_date"),
        F.max("_x").alias("x_last"),
    )
    c = {k: F.col(k) for k in ("n", "s2", "s3", "s4", "t0", "t1", "t2")}
    # The sum of x is 0; determinants of the 3 x 3 system by its first row.
    det = c["n"] * (c["s2"] * c["s4"] - c["s3"] ** 2) - c["s2"] ** 3
    d0 = c["t0"] * (c["s2"] * c["s4"] - c["s3"] ** 2) + c["s2"] * (c["t1"] * c["s3"] - c["s2"] * c["t2"])
    d1 = c["n"] * (c["t1"] * c["s4"] - c["s3"] * c["t2"]) + c["s2"] * (c["t0"] * c["s3"] - c["t1"] * c["s2"])
    d2 = c["n"] * (c["s2"] * c["t2"] - c["t1"] * c["s3"]) - c["t0"] * c["s2"] ** 2
    solved = sums.withColumns({"b0": ratio(d0, det), "b1": ratio(d1, det), "b2": ratio(d2, det)})
    at = F.col("x_last") + F.col("step")
    reach = quantile_of(interval) * F.col("sigma")
    future = add_future(solved, F.lit(horizon)).withColumn(
        "_y", F.col("b0") + F.col("b1") * at + F.col("b2") * at * at
    )
    floor = lambda v: F.when(v.isNotNull(), F.greatest(v, F.lit(0.0)))
    return future.select(
        *GROUP, "step", "ds",
        floor(F.col("_y")).alias("yhat"),
        floor(F.col("_y") - reach).alias("yhat_lower"),
        floor(F.col("_y") + reach).alias("yhat_upper"),
    )


def holdout_split(df: DataFrame, share: float = 0.8) -> DataFrame:
    """``part``: the first int(share·n) rows of a series are 'train', the rest 'test'.

    ``step`` numbers the test rows from 1.
    """
    size = F.count(F.lit(1)).over(W.partitionBy(*GROUP))
    row = F.row_number().over(over_time())
    cut = F.floor(size * share)
    return df.withColumns({"_row": row, "_cut": cut}).withColumns(
        {
            "part": F.when(F.col("_row") <= F.col("_cut"), "train").otherwise("test"),
            "step": (F.col("_row") - F.col("_cut")).cast("int"),
        }
    ).drop("_row", "_cut")


def metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE (over non-zero actual values) by group."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    relative = F.when(y != 0, F.abs(error) / F.abs(y))
    return df.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(relative) * 100).alias("mape"),
    )


def evaluate_forecasts(df: DataFrame, share: float = 0.8, min_rows: int = MIN_ROWS) -> DataFrame:
    """Metrics of each model on the last rows of every series (model, product, region, …)."""
    split = holdout_split(df, share)
    train = fit_gate(split.where("part = 'train'").drop("part", "step"), min_rows)
    test = split.where("part = 'test'").select(*GROUP, "step", F.col("price").alias("actual"))
    steps = test.groupBy(*GROUP).agg(F.max("step").alias("_h"))
    horizon = F.col("_h")
    trend = predict_seasonal_trend(fit_seasonal_trend(train).join(steps, GROUP), horizon)
    ar = predict_autoregressive(fit_autoregressive(train).join(steps, GROUP), horizon)
    both = combine(trend, ar).join(test, [*GROUP, "step"])
    models = F.expr(
        "stack(3, 'trend', trend_yhat, 'autoregressive', ar_yhat, 'ensemble', ensemble_yhat)"
        " as (model, predicted)"
    )
    return metrics(both.select(*GROUP, "actual", models), "actual", "predicted", ["model", *GROUP])


def best_match(names: DataFrame, requested: str, column: str = "name") -> DataFrame:
    """One row: the name equal to the request, else the first that contains it or is in it."""
    wanted, lower = F.lit(requested.lower()), F.lower(column)
    rank = F.when(lower == wanted, 0).when(F.contains(lower, wanted) | F.contains(wanted, lower), 1)
    return (
        names.select(column).distinct().withColumn("_rank", rank).where("_rank is not null")
        .orderBy("_rank", column).limit(1).select(column)
    )


def pick_best_series(
    df: DataFrame, product: str, region: str, min_dates: int = MIN_ROWS
) -> DataFrame:
    """One row: the matched series if it has enough dates, else the one with most."""
    counts = df.groupBy(*GROUP).agg(F.countDistinct("date").alias("n_months"))
    match = lambda c, wanted: best_match(counts, wanted, c).scalar()
    asked = (
        (F.col("product") == match("product", product))
        & (F.col("region") == match("region", region))
        & (F.col("n_months") >= min_dates)
    )
    return (
        counts.withColumn("matched", F.coalesce(asked, F.lit(False)))
        .orderBy(F.desc("matched"), F.desc("n_months"), *GROUP)
        .limit(1)
    )


def denormalise_forecast(
    forecast: DataFrame, history: DataFrame, value: str = "yhat"
) -> DataFrame:
    """value · deviation + mean of the series' history; deviation 0 counts as 1."""
    figures = history.groupBy(*GROUP).agg(
        F.avg("price").alias("_mean"), F.stddev_samp("price").alias("_sd")
    )
    spread = F.when(F.col("_sd") == 0, 1.0).otherwise(F.col("_sd"))
    return (
        forecast.join(figures, GROUP)
        .withColumn(value, F.col(value) * spread + F.col("_mean"))
        .drop("_mean", "_sd")
    )


def future_only(forecast: DataFrame, history: DataFrame) -> DataFrame:
    """Forecast rows after the last date of their series' history."""
    last = history.groupBy(*GROUP).agg(F.max("date").alias("_last"))
    return forecast.join(last, GROUP).where(F.col("ds") > F.col("_last")).drop("_last")


def last_steps(forecast: DataFrame, horizon: int, extra: int = 24) -> DataFrame:
    """The last horizon + extra rows of each series."""
    place = F.row_number().over(W.partitionBy(*GROUP).orderBy(F.desc("ds")))
    return forecast.withColumn("_r", place).where(F.col("_r") <= horizon + extra).drop("_r")


def forecast_reply(
    history: DataFrame, product: str, region: str, horizon: int = 6
) -> DataFrame:
    """Rounded forecast of one series; LookupError when product or region is unknown."""
    for column, wanted in (("product", product), ("region", region)):
        if history.where(F.col(column) == wanted).select(column).isEmpty():
            raise LookupError(f"{column.title()} '{wanted}' not found.")
    if not 1 <= horizon <= 24:
        raise ValueError("horizon must be between 1 and 24")
    one = history.where((F.col("product") == product) & (F.col("region") == region))
    return forecast_ensemble(one, horizon).select(
        F.date_format("ds", "yyyy-MM-dd").alias("date"),
        *[F.round(c, 2).alias(c) for c in ("ensemble_yhat", "trend_yhat", "yhat_lower", "yhat_upper")],
    )


def history_with_forecast(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History rows followed by the future rows and their band, told apart by ``kind``."""
    past = history.select(*GROUP, F.col("date").alias("ds"), "price", F.lit("history").alias("kind"))
    future = future_only(forecast, history).withColumn("kind", F.lit("forecast"))
    return past.unionByName(future.drop("step"), allowMissingColumns=True)
