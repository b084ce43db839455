"""One regression for all series on windows of past features, iterated ahead."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ..functions.staging import stage
from .features import GROUP, build_sequences, normalise, over_time, scaler_parameters
from .forecast import add_future, fit_gate

WINDOW_FEATURES = ["month_sin", "month_cos", "is_ramadan", "pct_change_1m"]


def fit_window_regression(features: DataFrame, length: int = 60, regressor=None):
    """A pooled model of the next normalised price; the regressor may be any of pyspark.ml."""
    if "price_norm" not in features.columns:
        features = normalise(features)
    windows = build_sequences(features, length, "price_norm", WINDOW_FEATURES)
    rows = windows.select(array_to_vector(F.flatten("x")).alias("features"), F.col("y").alias("label"))
    regressor = regressor or LinearRegression(regParam=0.01)
    return regressor.fit(rows)


def last_windows(features: DataFrame, length: int) -> DataFrame:
    """The newest full window of every series and its date, by product and region."""
    names = ["price_norm", *[c for c in WINDOW_FEATURES if c in features.columns]]
    step = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names])
    back = over_time().rowsBetween(-(length - 1), 0)
    return (
        features.select(*GROUP, "date", F.collect_list(step).over(back).alias("x"))
        .groupBy(*GROUP)
        .agg(F.max_by("x", "date").alias("x"), F.max("date").alias("last_date"))
        .where(F.size("x") == length)
    )


def priced(paths: DataFrame, scales: DataFrame, horizon: int) -> DataFrame:
    """Normalised ``path`` arrays as a dated price per step."""
    dated = add_future(paths.select(*GROUP, "last_date", "path"), F.lit(horizon))
    price = F.get("path", F.col("step") - 1) * F.col("spread") + F.col("centre")
    return dated.join(scales, GROUP).select(*GROUP, "step", "ds", price.alias("yhat"))


def predict_window_regression(
    model, features: DataFrame, horizon: int = 12, length: int = 60
) -> DataFrame:
    """Feeds each prediction back as the newest price; other features keep their last value."""
    if "price_norm" not in features.columns:
        features = normalise(features)
    scales = scaler_parameters(features)
    state = stage(last_windows(features, length), "seeds").withColumn("path", F.expr("cast(array() as array<double>)"))
    for _ in range(horizon):
        scored = model.transform(state.withColumn("features", array_to_vector(F.flatten("x"))))
        kept = F.slice(F.element_at("x", -1), F.lit(2), F.size(F.element_at("x", -1)) - 1)
        newest = F.concat(F.array("prediction"), kept)
        state = scored.select(
            *GROUP,
            "last_date",
            F.concat(F.slice("x", 2, length - 1), F.array(newest)).alias("x"),
            F.concat("path", F.array("prediction")).alias("path"),
        )
    return priced(state, scales, horizon)


def forecast_window_regression(features: DataFrame, horizon: int = 12, length: int = 60) -> DataFrame:
    """Fits on every series with at least 24 rows, then forecasts those with a full window."""
    rows = fit_gate(features)
    return predict_window_regression(fit_window_regression(rows, length), rows, horizon, length)
