import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.operators import features as X
from test_cleaning import series


def test_features_equal_pandas(spark, panel, clean_rows):
    got = X.build_features(panel).toPandas().sort_values(["product", "region", "date"])
    want = clean_rows.sort_values(["product", "region", "date"])
    group = want.groupby(["product", "region"])["price"]
    for k in X.LAGS:
        assert np.allclose(got[f"lag_price_{k}m"], group.shift(k), equal_nan=True)
    for n in X.WINDOWS:
        for stat in ("mean", "std", "min", "max"):
            rolled = group.transform(lambda s: getattr(s.rolling(n, min_periods=1), stat)())
            assert np.allclose(got[f"rolling_{n}m_{stat}"], rolled.fillna(0))
    for k in X.CHANGES:
        assert np.allclose(got[f"pct_change_{k}m"], group.pct_change(k) * 100, equal_nan=True)
    national = want.groupby(["product", "date"])["price"].transform("mean")
    assert np.allclose(got["price_vs_national"], want["price"] / national)
    scaled = group.transform(lambda s: (s - s.min()) / (s.max() - s.min()))
    assert np.allclose(got["price_norm"], scaled)


def test_change_reads_a_gap_as_the_last_price(spark):
    out = X.pct_change_features(series(spark, [100.0, None, 110.0]), (1,)).orderBy("date").collect()
    assert [r.pct_change_1m for r in out] == [None, pytest.approx(0.0), pytest.approx(10.0)]


@pytest.mark.parametrize("method", ["minmax", "standard", "robust", "unheard-of"])
def test_inverse_of_normalise(spark, panel, method):
    normal = X.normalise(panel, method).withColumnRenamed("price", "was")
    back = X.inverse_normalise(normal, X.scaler_parameters(panel, method))
    assert back.where(F.abs(F.col("price") - F.col("was")) > 1e-9).count() == 0


def test_constant_series(spark):
    flat = series(spark, [5.0, 5.0])
    for method in ("minmax", "standard", "robust"):
        assert [r.price_norm for r in X.normalise(flat, method).collect()] == [0.0, 0.0]


def test_inverse_of_unknown_series(spark, panel):
    other = series(spark, [1.0]).withColumn("price_norm", F.lit(0.5))
    with pytest.raises(KeyError):
        X.inverse_normalise(other, X.scaler_parameters(panel))


def test_sequences(spark, panel):
    rows = X.build_features(panel)
    out = X.build_sequences(rows, 12)
    assert out.count() == 4 * (60 - 12)
    one = out.where("product = 'Figs' and region = 'North'").orderBy("date").collect()
    norm = [r.price_norm for r in rows.where("product = 'Figs' and region = 'North'").orderBy("date").collect()]
    assert [step[0] for step in one[0].x] == norm[:12] and one[0].y == norm[12]
    assert len(one[0].x[0]) == 8
    assert X.build_sequences(rows, 60).count() == 0
