"""The bent trend against numpy, and against the straight line on series with a bend."""

from datetime import date

import numpy as np
import pytest
from conftest import months
from pyspark.sql import functions as F

from bazaarline.operators import changepoints as cp


def test_solver_equals_numpy(spark):
    rng = np.random.default_rng(4)
    rows, want = [], []
    for i in range(6):
        p = i * 3 + 1
        x = rng.normal(size=(40, p))
        a, b = x.T @ x + 0.1 * np.eye(p), rng.normal(size=p)
        rows.append((i, [r[: k + 1] for k, r in enumerate(a.tolist())], b.tolist()))
        want.append(np.linalg.solve(a, b))
    df = spark.createDataFrame(rows, "i int, a array<array<double>>, b array<double>")
    made = df.withColumn("l", cp.cholesky(F.col("a"))).select("i", cp.solve(F.col("l"), F.col("b")).alias("x")).orderBy("i")
    for r, w in zip(made.collect(), want):
        assert np.allclose(r.x, w)


def design(bends, days):
    m = np.array([d.year * 12 + d.month for d in days], float)
    u = (m - m.min()) / (m.max() - m.min())
    cols = [np.ones(len(u)), u] + [np.maximum(u - c, 0) for c in bends.places]
    for h in range(1, bends.harmonics + 1):
        angle = 2 * np.pi * h * (np.array([d.month for d in days]) - 1) / 12
        cols += [np.sin(angle), np.cos(angle)]
    return np.column_stack(cols)


@pytest.mark.parametrize("multiplicative", [True, False])
def test_fit_equals_ridge_regression(spark, multiplicative):
    bends, days = cp.Bends(changes=5, harmonics=2, multiplicative=multiplicative), months(date(2015, 2, 1), 70)
    rng = np.random.default_rng(1)
    price = 50 + rng.normal(0, 3, 70) + np.arange(70) * 0.4
    df = spark.createDataFrame([(d, "a", "b", float(p)) for d, p in zip(days, price)], "date date, product string, region string, price double")
    model = cp.fit_changepoints(df, bends).first()
    x, y = design(bends, days), np.log(price) if multiplicative else price / price.max()
    beta = np.linalg.solve(x.T @ x + np.diag(bends.penalties), x.T @ y)
    assert np.allclose(model.beta, beta) and model.span == 69 and model.fit_rows == 70
    rest = (y - x @ beta) * model.scale
    assert model.sigma == pytest.approx(rest.std(ddof=1))
    points = cp.trend_changes(cp.fit_changepoints(df, bends), bends).orderBy("number").collect()
    assert [p.number for p in points] == [1, 2, 3, 4, 5] and points[-1].month == date(2019, 9, 1)
    assert points[-1].slope == pytest.approx(model.scale * sum(beta[1:7]) / 69)


def bent_series():
    """Prices that rise, then fall, with a season; and one straight series."""
    rows = []
    for k, turn in enumerate((30, 45, 60, None)):
        for i, d in enumerate(months(date(2014, 1, 1), 96)):
            level = 100 + 1.5 * (i if turn is None or i <= turn else 2 * turn - i)
            season = 1 + 0.08 * np.sin(2 * np.pi * i / 12)
            rows.append((d, f"p{k}", "r", float(level * season + ((i * 31) % 11 - 5) * 0.3)))
    return rows


def test_better_than_a_line_where_the_trend_bends(spark):
    df = spark.createDataFrame(bent_series(), "date date, product string, region string, price double")
    made = {r.product: r for r in cp.evaluate_changepoints(df).collect()}
    for p in ("p0", "p1"):
        assert made[p].mae_bent < 0.5 * made[p].mae_line, made[p]
    assert made["p2"].mae_bent < made["p2"].mae_line  # it bends where the last hinge is
    assert made["p3"].mae_bent < 0.06 * 240 and made["p3"].n_test == 20
    ahead = cp.forecast_changepoints(df, 6).where("product = 'p0'").orderBy("step").collect()
    widths = [r.yhat_upper / r.yhat_lower for r in ahead]
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in ahead) and widths[-1] > widths[0]


def test_rows_that_cannot_be_fitted(spark):
    schema = "date date, product string, region string, price double"
    days = months(date(2020, 1, 1), 30)
    rows = [(d, "gaps", "r", None if i % 5 == 0 else float(10 + i)) for i, d in enumerate(days)]
    rows += [(d, "short", "r", 5.0) for d in days[:23]] + [(d, "flat", "r", 7.0) for d in days]
    rows += [(d, "odd", "r", float("nan") if i == 3 else -1.0 if i == 4 else 9.0) for i, d in enumerate(days)]
    rows += [(days[0], "same", "r", 4.0 + i) for i in range(24)]
    made = cp.forecast_changepoints(spark.createDataFrame(rows, schema), 3)
    got = {}
    for r in made.collect():
        got.setdefault(r.product, []).append(r.yhat)
    assert set(got) == {"gaps", "flat", "odd", "same"}
    assert got["flat"] == pytest.approx([7.0] * 3) and got["odd"] == pytest.approx([9.0] * 3)
    assert all(np.isfinite(v).all() for v in got.values())
    assert made.limit(0).collect() == [] and cp.forecast_changepoints(spark.createDataFrame([], schema)).count() == 0
