from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.operators import analytics as Q
from bazaarline.operators import features as X
from bazaarline.operators import forecast as P
from bazaarline.operators import window_model as M
from test_cleaning import series


def test_seasonal_trend_follows_a_season(spark):
    """The line is fitted before the season, which tilts it by a few percent."""
    t = np.arange(60)
    season = 1 + 0.2 * np.sin(2 * np.pi * (t % 12) / 12)
    out = P.forecast_seasonal_trend(series(spark, [float(v) for v in 100 * season], date(2019, 1, 1))).orderBy("step").collect()
    assert len(out) == 12 and out[0].ds == date(2024, 1, 1)
    assert [r.yhat for r in out] == pytest.approx(list(100 * season[:12]), rel=0.06)
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)


def test_autoregressive(spark):
    prices = [100.0]
    for _ in range(40):
        prices.append(20 + 0.8 * prices[-1] + 3.0 * (-1) ** len(prices))
    y = np.array(prices)
    slope, intercept = np.polyfit(y[:-1], y[1:], 1)
    want, last = [], y[-1]
    for _ in range(12):
        last = intercept + slope * last
        want.append(last)
    out = P.forecast_autoregressive(series(spark, prices)).orderBy("step").collect()
    assert [r.yhat for r in out] == pytest.approx(want)


def test_constant_and_short_series(spark):
    assert {r.yhat for r in P.forecast_autoregressive(series(spark, [7.0] * 24)).collect()} == {7.0}
    assert P.forecast_ensemble(series(spark, [7.0] * 23)).count() == 0
    assert P.skipped_series(series(spark, [7.0] * 23)).head().n_rows == 23


def test_quadratic_equals_polyfit(spark):
    rng = np.random.default_rng(0)
    y = 5 + 0.3 * np.arange(40) + 0.01 * np.arange(40) ** 2 + rng.normal(0, 1, 40)
    out = P.forecast_quadratic(series(spark, [float(v) for v in y]), 6).orderBy("step").collect()
    want = np.polyval(np.polyfit(np.arange(40), y, 2), np.arange(40, 46))
    assert [r.yhat for r in out] == pytest.approx(list(want))
    assert out[0].yhat_upper - out[0].yhat == pytest.approx(1.64 * y.std())
    falling = P.forecast_quadratic(series(spark, [float(v) for v in range(24, 0, -1)]), 24)
    assert falling.where("yhat < 0 or yhat_lower < 0").count() == 0


def test_ensemble_weights(spark, panel):
    both = P.forecast_ensemble(panel)
    assert both.count() == 4 * 12
    assert both.where(F.abs(F.col("ensemble_yhat") - (F.col("trend_yhat") + F.col("ar_yhat")) / 2) > 1e-9).count() == 0
    alone = P.forecast_ensemble(panel, 6, 1.0, 0.0)
    assert alone.where("ensemble_yhat <> trend_yhat or ar_yhat <> trend_yhat").count() == 0


def test_split_and_metrics(spark, panel):
    split = P.holdout_split(panel)
    assert split.where("part = 'train'").count() == 4 * 48
    assert [r.step for r in split.where("part = 'test' and product = 'Figs' and region = 'North'").orderBy("date").collect()] == list(range(1, 13))
    df = spark.createDataFrame([(100.0, 200.0), (200.0, 400.0)], "y double, p double")
    assert P.metrics(df, "y", "p").head().mape == pytest.approx(100)
    zero = spark.createDataFrame([(0.0, 50.0), (100.0, 110.0)], "y double, p double")
    assert P.metrics(zero, "y", "p").head().mape == pytest.approx(10)
    assert tuple(P.metrics(df, "y", "y").head()) == (0, 0, 0)
    assert P.evaluate_forecasts(panel).count() == 3 * 4


def test_matching(spark):
    names = spark.createDataFrame([("Tomatoes",), ("Onions",), ("Tom",)], "name string")
    assert P.best_match(names, "tomatoes").head().name == "Tomatoes"
    assert P.best_match(names, "tomatoes fresh").head().name == "Tom"
    assert P.best_match(names, "Riz").head() is None
    assert P.best_match(names, "nion").head().name == "Onions"


def test_reply_and_limits(spark, panel):
    assert P.forecast_reply(panel, "Figs", "North", 6).count() == 6
    with pytest.raises(LookupError, match="Product"):
        P.forecast_reply(panel, "Nothing", "North")
    with pytest.raises(LookupError, match="Region"):
        Q.query_prices(panel, region="Nowhere")
    with pytest.raises(ValueError):
        P.future_calendar(panel, 25)
    with pytest.raises(ValueError):
        Q.query_prices(panel, limit=5001)
    newest = Q.query_prices(panel, "Figs", limit=3).collect()
    assert [r.date for r in newest] == ["2024-06-01", "2024-06-01", "2024-05-01"]


def test_window_regression(spark):
    t = np.arange(96)
    wave = 100 + 10 * np.sin(2 * np.pi * t / 12)
    rows = X.build_features(series(spark, [float(v) for v in wave], date(2015, 1, 1)))
    out = M.forecast_window_regression(rows.select("product", "region", "date", "price", "price_norm"), 12, 24)
    got = [r.yhat for r in out.orderBy("step").collect()]
    assert len(got) == 12 and np.abs(np.array(got) - wave[:12]).max() < 3


def test_null_profile_and_trend(spark, panel):
    profile = Q.null_profile(panel.withColumn("price", F.when(F.month("date") > 1, F.col("price")))).head()
    assert profile.missing_price == 20 and profile.min_year == 2019
    assert Q.price_trend(panel).count() == 120


def test_any_interval_width(spark, panel):
    assert P.quantile_of(0.95) == 1.96 and P.quantile_of(0.8) == pytest.approx(1.2816, abs=1e-4)
    wide = P.forecast_quadratic(panel, 3, 0.99).head()
    narrow = P.forecast_quadratic(panel, 3, 0.5).where((F.col("product") == wide["product"]) & (F.col("region") == wide.region)).where(F.col("step") == wide.step).head()
    assert wide.yhat_upper - wide.yhat_lower > narrow.yhat_upper - narrow.yhat_lower > 0
    with pytest.raises(ValueError):
        P.quantile_of(1.5)


def test_window_regression_is_a_ridge_regression(spark, panel):
    """The fitted model against normal equations solved in numpy, on all windows."""
    rows = X.normalise(panel)
    model = M.fit_window_regression(rows, 12)
    windows = X.build_sequences(rows, 12, "price_norm", M.WINDOW_FEATURES).collect()
    x = np.array([np.ravel(w.x) for w in windows])
    y = np.array([w.y for w in windows])
    wide = x.std(0)
    used = wide > 0
    z, goal = (x[:, used] - x[:, used].mean(0)) / wide[used], y - y.mean()
    # the penalty counts on features and a label of unit deviation
    weights = np.linalg.solve(z.T @ z / len(y) + 0.01 / y.std() * np.eye(z.shape[1]), z.T @ goal / len(y))
    want = z @ weights + y.mean()
    got = x @ model.coefficients.toArray() + model.intercept
    assert np.abs(got - want).max() < 1e-6
