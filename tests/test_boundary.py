"""The one-class problem: optimality conditions, the share outside, and its nu = 1 case."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from bazaarline.operators import anomaly as A, boundary as B
from bazaarline.settings import Settings


def kernel(x, gamma):
    return np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))


def check(x, n, nu, gamma, weight, rho):
    """Karush-Kuhn-Tucker conditions of min ½ aKa, 0 <= a <= C, sum a = 1."""
    bound = n / (nu * n.sum())
    assert weight.sum() == pytest.approx(1) and (weight >= 0).all() and (weight <= bound + 1e-9).all()
    force = kernel(x, gamma) @ weight
    assert (force[weight <= 1e-9] >= rho - 1e-5).all()
    assert (force[weight >= bound - 1e-9] <= rho + 1e-5).all()
    assert np.allclose(force[(weight > 1e-9) & (weight < bound - 1e-9)], rho, atol=1e-5)
    return force


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 60), st.sampled_from([0.01, 0.05, 0.2, 0.5, 0.9, 1.0]), st.integers(0, 10**6))
def test_optimality_conditions(size, nu, seed):
    rng = np.random.default_rng(seed)
    x, n = rng.normal(size=(size, 3)), rng.integers(1, 4, size).astype(float)
    weight, rho = B.one_class(x, n, nu, 1 / 3)
    check(x, n, nu, 1 / 3, weight, rho)


def test_columns_made_when_needed_give_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    x, n = rng.normal(size=(150, 4)), np.ones(150)
    whole = B.one_class(x, n, 0.1, 0.25)
    monkeypatch.setattr(B, "WHOLE", 16)
    parts = B.one_class(x, n, 0.1, 0.25)
    assert np.allclose(whole[0], parts[0]) and whole[1] == pytest.approx(parts[1])


def test_at_most_nu_of_the_rows_are_outside(spark):
    rng = np.random.default_rng(8)
    rows = [(k, float(a), float(b)) for k in ("p", "q") for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    for nu in (0.05, 0.3):
        fitted = B.fit_boundary(df, ["k"], ["a", "b"], nu=nu)
        scored = B.add_similarity(df, fitted, ["k"], ["a", "b"], "s").join(fitted.select("k", "offset"), "k")
        for r in scored.groupBy("k").agg(F.avg((F.col("s") < F.col("offset") - B.MARGIN).cast("int")).alias("out")).collect():
            assert 0 < r.out <= nu
        for r in fitted.collect():
            assert nu * 200 - 1e-6 <= len(r.boundary) < 200


def test_nu_of_one_is_the_kernel_mean(spark):
    rows = [("g", 1.0, 2.0), ("g", 1.0, 2.0), ("g", 3.0, -1.0), ("g", 0.0, 0.5), ("one", 4.0, 4.0)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    plain = B.fit_boundary(df, ["k"], ["a", "b"])
    solved = B.solve_boundary(plain, 2, 1.0)
    both = [B.add_similarity(df, f, ["k"], ["a", "b"], "s").orderBy("k", "a").collect() for f in (plain, solved)]
    assert [r.s for r in both[0]] == pytest.approx([r.s for r in both[1]])
    with pytest.raises(ValueError):
        B.solve_boundary(plain, 2, 0.0)


def test_missing_features_and_empty_tables(spark):
    df = spark.createDataFrame([("g", 1.0, None), ("g", 2.0, 3.0), ("h", None, None)], "k string, a double, b double")
    made = {r.k: r for r in B.fit_boundary(df, ["k"], ["a", "b"], nu=0.5).collect()}
    assert len(made["g"].boundary) == 1 and made["h"].boundary == [] and made["h"].offset is None
    assert B.fit_boundary(df.where("false"), ["k"], ["a", "b"], nu=0.5).count() == 0


def test_detector_with_the_usual_nu(spark, spiked):
    """Spikes are found, and the boundary score tells them from the rest."""
    scored = A.score_panel(spiked, Settings(trees=50, nu=0.05))
    rows = scored.collect()
    assert all(0 <= r.anomaly_score <= 1 and 0 <= r.svm_score <= 1 for r in rows)
    odd = {(r.product, r.region): [] for r in rows}
    for r in rows:
        odd[r.product, r.region].append((r.price, r.svm_score))
    for series in odd.values():
        series.sort()
        assert min(s for _, s in series[-3:]) > np.median([s for _, s in series])
