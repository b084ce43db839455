"""Chunked windows and blocked correlations equal the plain operators."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.functions.staging import stage
from bazaarline.operators import analytics, anomaly, chunks, features, gram

SCHEMA = "date date, product string, region string, price double, note string"


@pytest.fixture(scope="module")
def long(spark):
    """One series with nine tenths of the rows, with gaps of days, of chunks and of prices."""
    rng = np.random.default_rng(6)
    rows = []
    for product, n in (("hot", 1800), ("thin", 90), ("gap", 60), ("one", 1), ("void", 30)):
        day = date(2001, 3, 4)
        for i in range(n):
            day += timedelta(days=int(rng.integers(1, 4)) + (700 if product == "gap" and i % 20 == 19 else 0))
            missing = product == "void" or rng.random() < 0.2 or (product == "hot" and 300 < i < 520)
            rows.append((day, product, "r", None if missing else float(np.round(rng.uniform(5, 50), 2)), f"{i}"))
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(4), "long")


def same(a, b):
    key = lambda r: (r.product, r.region, str(r.date))
    left, right = sorted(a.collect(), key=key), sorted(b.select(a.columns).collect(), key=key)
    assert len(left) == len(right) > 0
    for x, y in zip(left, right):
        for name in a.columns:
            u, v = x[name], y[name]
            assert u == v or (isinstance(u, float) and u == pytest.approx(v, rel=1e-9, abs=1e-9)), (name, x, y)


@pytest.mark.parametrize("days", [5, 90, 10_000])
def test_windows_by_chunk(long, days):
    same(features.lag_features(long), chunks.long_lags(long, days=days))
    same(features.rolling_features(long), chunks.long_rolling(long, days=days))
    same(features.pct_change_features(long), chunks.long_changes(long, days=days))
    priced = long.where("price is not null")
    same(anomaly.detection_features(priced), chunks.long_detection(priced, days=days))
    same(anomaly.detection_features(priced, 1), chunks.long_detection(priced, 1, days=days))


@pytest.mark.parametrize("method", ["minmax", "standard", "robust", "unheard of"])
def test_figures_of_whole_series(long, method):
    same(features.normalise(long, method), chunks.long_normalise(long, method))


def test_other_figures(long):
    same(features.price_vs_national(long), chunks.long_national(long))
    plain = long.withColumn("score", anomaly.normalise_score(F.col("price")))
    same(plain, chunks.long_normalise_score(long, "price"))
    same(features.build_features(long, "robust"), chunks.build_long_features(long, "robust", 200))


def test_a_hot_series_is_in_several_tasks(spark, long):
    """And no window is by the whole series of rows."""
    made = chunks.long_rolling(long, days=200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = made.where("product = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) > 2 and max(r["count"] for r in hot) < 1500
    assert "Window" not in chunks.long_normalise(long, "robust")._jdf.queryExecution().optimizedPlan().toString()


def test_missing_keys_and_empty_tables(spark):
    rows = [(None, "a", "r", 1.0, ""), (date(2020, 1, 1), None, "r", 2.0, ""), (date(2020, 1, 2), "a", "r", 3.0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert chunks.long_lags(df, days=30).count() == 3
    assert chunks.long_changes(df.where("false")).count() == 0 == chunks.long_normalise(df.where("false")).count()


def pairs(df):
    return {(r.product_a, r.product_b): (r.correlation, r.n_dates) for r in df.collect()}


@pytest.mark.parametrize("block,dates", [(256, 512), (3, 7), (1, 1000)])
def test_blocked_correlations(spark, block, dates):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(10):
        for i in range(60):
            if rng.random() < 0.7:
                rows.append((date(2020, 1, 1) + timedelta(days=i), f"p{k}", f"r{i % 2}", None if rng.random() < 0.1 else 1e6 + float(rng.normal() + (k % 3) * i), ""))
    rows += [(date(2020, 1, 1) + timedelta(days=i), "flat", "r", 5.0, "") for i in range(60)]
    rows += [(date(2020, 1, 5), "once", "r", 5.0, ""), (date(1999, 1, 1), "alone", "r", 5.0, ""), (None, "p1", "r", 1.0, ""), (date(2020, 1, 5), None, "r", 1.0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    means = {}
    for d, p, _, price, _ in rows:
        if d and p:
            means.setdefault(p, {}).setdefault(d, []).append(price)
    means = {p: {d: np.mean([v for v in vs if v is not None]) if any(v is not None for v in vs) else None for d, vs in of.items()} for p, of in means.items()}
    want = {}
    for a in means:
        for b in means:
            common = set(means[a]) & set(means[b])
            if a > b and common:
                both = [(means[a][d], means[b][d]) for d in common if means[a][d] is not None and means[b][d] is not None]
                x, y = (np.array(v) for v in zip(*both)) if both else (np.zeros(0), np.zeros(0))
                flat = len(both) < 2 or np.ptp(x) == 0 or np.ptp(y) == 0
                want[a, b] = (None if flat else np.corrcoef(x, y)[0, 1], len(both))
    made = pairs(gram.product_correlation(df, block, dates))
    assert made.keys() == want.keys()
    for k, (value, n) in want.items():
        assert made[k][1] == n
        assert made[k][0] == (value if value is None else pytest.approx(value, abs=1e-6)), k
    plain = pairs(analytics.product_correlation(df.dropna(subset=["product", "date"])))
    assert plain.keys() == made.keys()


def test_no_products(spark):
    assert gram.product_correlation(spark.createDataFrame([], SCHEMA)).count() == 0
