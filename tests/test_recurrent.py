"""The recurrent cell: gradients, sums over tasks, training and holdout error."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.operators import features as X, recurrent as R, window_model as M
from conftest import months

LENGTH = 12


@pytest.fixture(scope="module")
def swings(spark):
    """Six series whose next price depends on the last ones in a bent way, with a year's wave."""
    rows = []
    for k in range(6):
        random, price = np.random.default_rng(k), 0.3 + 0.05 * k
        for i, day in enumerate(months(date(2012, 1, 1), 120)):
            price = 0.1 + 3.4 * price * (1 - price) * 0.9 + 0.05 * np.sin(2 * np.pi * i / 12) + random.normal(0, 0.004)
            price = min(max(price, 0.02), 0.98)
            rows.append((day, f"p{k % 3}", f"r{k % 2}", float(100 + 50 * price)))
    return X.build_features(spark.createDataFrame(rows, "date date, product string, region string, price double")).select(
        "product", "region", "date", "price", "price_norm", "month_sin", "month_cos", "is_ramadan", "pct_change_1m"
    ).cache()


def test_gradient_is_the_derivative():
    random = np.random.default_rng(1)
    x, y = random.normal(0, 1, (7, 9, 3)), random.normal(0, 1, 7)
    cell = R.Cell.start(3, 4)
    cell = R.replace(cell, weights=random.normal(0, 0.5, len(cell.weights)))
    loss, slope = cell.gradient(x, y)
    assert loss == pytest.approx(((cell.predict(x) - y) ** 2).sum())
    for i in range(len(slope)):
        step = np.zeros_like(slope)
        step[i] = 1e-5
        up, down = (R.replace(cell, weights=cell.weights + s).gradient(x, y)[0] for s in (step, -step))
        assert slope[i] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("tasks", [1, 5, 40])
def test_sums_over_tasks_are_those_of_all_windows(spark, swings, tasks):
    windows = X.build_sequences(swings, LENGTH, "price_norm", M.WINDOW_FEATURES)
    rows = windows.collect()
    cell = R.Cell.start(5, 3, seed=7)
    cell = R.replace(cell, weights=cell.weights + 0.1)
    loss, slope = cell.gradient(np.array([r.x for r in rows]), np.array([r.y for r in rows]))
    n, total, sums = R.total_gradient(windows.repartition(tasks), cell)
    assert n == len(rows) and total == pytest.approx(loss)
    np.testing.assert_allclose(sums, slope, rtol=1e-9, atol=1e-9)


def test_holdout_error_is_not_above_the_regressions(spark, swings):
    """One-step error on the last two years, both models fitted on the years before."""
    before = swings.where("date < '2020-01-01'")
    cell = R.fit_recurrent(before, LENGTH)
    model = M.fit_window_regression(before, LENGTH)
    held = X.build_sequences(swings, LENGTH, "price_norm", M.WINDOW_FEATURES).where("date >= '2020-01-01'").collect()
    x, y = np.array([r.x for r in held]), np.array([r.y for r in held])
    own = np.sqrt(((cell.predict(x) - y) ** 2).mean())
    linear = x.reshape(len(x), -1) @ model.coefficients.toArray() + model.intercept
    assert own <= np.sqrt(((linear - y) ** 2).mean())


def test_forecast_feeds_predictions_back(spark, swings, tmp_path):
    cell = R.fit_recurrent(swings, LENGTH, hidden=4, rounds=3)
    R.save_cell(spark, cell, str(tmp_path / "cell"))
    cell = R.load_cell(spark, str(tmp_path / "cell"))
    out = R.predict_recurrent(cell, swings, 4, LENGTH).orderBy("product", "region", "step").collect()
    assert len(out) == 6 * 4 and [r.step for r in out[:4]] == [1, 2, 3, 4]
    scales = {(r["product"], r.region): r for r in X.scaler_parameters(swings).collect()}
    seeds = M.last_windows(swings, LENGTH).collect()
    for seed in seeds:
        x, scale = np.array([seed.x]), scales[seed["product"], seed.region]
        own = [r.yhat for r in out if (r["product"], r.region) == (seed["product"], seed.region)]
        for got in own:
            y = cell.predict(x)[0]
            assert got == pytest.approx(y * scale.spread + scale.centre)
            x = np.concatenate([x[:, 1:], np.array([[[y, *x[0, -1, 1:]]]])], axis=1)


def test_too_short_series_give_nothing(spark, swings):
    assert R.forecast_recurrent(swings.where("date < '2012-10-01'"), 3, LENGTH).count() == 0
    cell = R.fit_recurrent(swings.where("date < '2012-10-01'"), LENGTH)
    assert cell.predict(np.array([[[0.25, 0, 0, 0, 0]] * 3]))[0] == 0.25
