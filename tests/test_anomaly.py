from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.functions.staging import new_path
from bazaarline.operators import anomaly as A
from bazaarline.operators.boundary import add_similarity, fit_boundary
from bazaarline.settings import Settings
from conftest import SPIKES
from test_cleaning import series

FAST = Settings(trees=50)


@pytest.fixture(scope="module")
def scored(spark, spiked):
    return A.score_panel(spiked, FAST).cache()


def test_detector_per_series(spark, spiked):
    short = series(spark, [1.0] * 5).withColumn("pct_change_1m", F.lit(0.0)).select(*spiked.columns)
    both = spiked.union(short)
    assert A.fit_detector(both, FAST).count() == 4
    rest = A.score_panel(both, FAST).where("product = 'P'").collect()
    assert [(r.anomaly_score, r.is_anomaly) for r in rest] == [(0.0, False)] * 5


def test_missing_columns(spark):
    with pytest.raises(ValueError):
        A.fit_detector(spark.createDataFrame([(100, "Alger")], "price int, region string"))


def test_scores(scored):
    rows = scored.collect()
    assert len(rows) == 288
    assert all(0 <= r.anomaly_score <= 1 and 0 <= r.if_score <= 1 and 0 <= r.svm_score <= 1 for r in rows)
    assert sum(r.is_anomaly for r in rows) >= 4


def test_spikes_score_highest(scored, spiked_rows):
    for (product, region), part in spiked_rows.groupby(["product", "region"]):
        one = scored.where((F.col("product") == product) & (F.col("region") == region))
        best = {r.date for r in one.orderBy(F.desc("anomaly_score")).limit(6).collect()}
        spikes = set(part["date"].iloc[list(SPIKES)])
        assert len(best & spikes) >= 2


def kernel_mean(x):
    return np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / x.shape[1]).mean(1)


def test_similarity_is_the_exact_kernel_mean(spark):
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=(100, 6)), rng.normal(4, 1, size=(3, 6))]
    x = np.r_[x, x[:20]]  # repeated rows weigh twice
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([("P", "R", i, *map(float, v)) for i, v in enumerate(x)], ["product", "region", "id", *names])
    out = add_similarity(df, fit_boundary(df, A.GROUP, names), A.GROUP, names, "s").orderBy("id").collect()
    assert len(out) == len(x) and [r.s for r in out] == pytest.approx(kernel_mean(x), abs=1e-9)
    with pytest.raises(Exception, match="more than 50 distinct rows"):
        fit_boundary(df, A.GROUP, names, longest=50).collect()


def test_every_row_keeps_its_score(spark, spiked):
    """Rows that are equal in every column are scored, not merged."""
    twice = spiked.union(spiked.where("month(date) = 3"))
    scored = A.score_panel(twice, FAST)
    assert scored.count() == twice.count() == 312
    simple = twice.withColumns({"rolling_3m": F.col("price")})
    assert A.isolation_score_simple(simple).count() == 312


def test_normalise_score(spark):
    df = spark.createDataFrame([("P", "R", v) for v in (-0.5, 0.0, 0.5, 1.0)], "product string, region string, v double")
    assert sorted(r.s for r in df.select(A.normalise_score(F.col("v")).alias("s")).collect()) == pytest.approx([0, 1 / 3, 2 / 3, 1])
    flat = df.withColumn("v", F.lit(0.3))
    assert {r.s for r in flat.select(A.normalise_score(F.col("v")).alias("s")).collect()} == {0.0}


def test_severity(spark):
    df = spark.createDataFrame([(0.97,), (0.87,), (0.78,), (0.72,)], "s double")
    assert [r.g for r in df.select(A.severity(F.col("s")).alias("g")).collect()] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_alerts(spark):
    df = spark.createDataFrame(
        [(date(2023, 6, 1), "Tomates", "Alger", 250.0, 0.88, True, -3.14), (date(2023, 7, 1), "Tomates", "Alger", 250.4, 0.71, True, None), (date(2023, 8, 1), "Tomates", "Alger", 1.0, 0.1, False, 0.0)],
        "date date, product string, region string, price double, anomaly_score double, is_anomaly boolean, pct_change_1m double",
    )
    first, second = A.generate_alerts(df).orderBy("date").collect()
    assert (first.severity, first.anomaly_score, first.algorithm) == ("HIGH", 0.88, "ensemble")
    assert first.message == "Tomates price in Alger on 2023-06: 250 DZD (▼3.1% MoM). Anomaly score: 0.88."
    assert "(▲0.0% MoM)" in second.message


def test_saved_detector(spark, spiked, scored):
    path = new_path(spark, "detector")
    A.save_detector(A.fit_detector(spiked, FAST), path, 0.7)
    again = A.predict(spiked, A.load_detector(spark, path), FAST)
    assert again.exceptAll(scored).count() == 0


def by_definition(history, new, detector, settings):
    """Every observation put into its own copy of its series, and the copies scored."""
    columns = ["obs_id", *A.GROUP, "date", "price", "_new"]
    past = new.select("obs_id", *A.GROUP).join(history, A.GROUP).withColumn("_new", F.lit(False))
    copies = new.withColumn("_new", F.lit(True)).select(columns).unionByName(past.select(columns))
    scored = A.predict(copies, detector, settings, ["obs_id", *A.GROUP], ("date", "_new"), A.GROUP)
    return {r.obs_id: r for r in scored.where("_new").collect()}


@pytest.mark.parametrize("window", [1, 2, 6])
def test_new_observations_equal_their_definition(spark, spiked, window):
    settings = Settings(trees=30, window=window)
    history = spiked.select(*A.GROUP, "date", "price").where("month(date) <> 9")
    detector = A.fit_detector(history, settings)
    rows = [
        (f"{i}", "Tomates", "Alger", day, price)
        for i, (day, price) in enumerate(
            [(date(2030, 1, 1), 500.0), (date(2023, 3, 1), 100.0), (date(1999, 1, 1), 90.0), (date(2017, 3, 1), 91.0),
             (date(2017, 4, 17), 400.0), (date(2019, 9, 5), 95.0), (date(2023, 1, 31), 10.0), (date(2018, 5, 1), 300.0)]
        )
    ]
    new = spark.createDataFrame(rows, "obs_id string, product string, region string, date date, price double")
    got = {r.obs_id: r for r in A.score_new_observations(history, new, detector, settings).collect()}
    want = by_definition(history, new, detector, settings)
    assert set(got) == set(want) == {r[0] for r in rows}
    for obs, row in want.items():
        assert got[obs].anomaly_score == pytest.approx(round(row.anomaly_score, 4), abs=1.01e-4), row
        assert got[obs].is_anomaly == row.is_anomaly and got[obs].found


def test_new_observations_do_not_affect_each_other(spark, spiked):
    detector = A.fit_detector(spiked, FAST)
    history = spiked.select(*A.GROUP, "date", "price")
    rows = [("a", "Tomates", "Alger", date(2024, 1, 1), 500.0), ("b", "Tomates", "Alger", date(2024, 1, 1), 100.0), ("c", "Tomates", "Nowhere", date(2024, 1, 1), 1.0), ("a", "Lamb", "South", date(2024, 1, 1), 5.0)]
    new = spark.createDataFrame(rows, "obs_id string, product string, region string, date date, price double")
    together = A.score_new_observations(history, new, detector, FAST).collect()
    assert len(together) == 4  # an id that repeats keeps both rows
    found = {(r.obs_id, r.product): r for r in together}
    alone = A.score_new_observations(history, new.where("obs_id = 'b'"), detector, FAST).head()
    assert found["b", "Tomates"] == alone
    assert found["a", "Tomates"].is_anomaly and found["a", "Tomates"].anomaly_score > alone.anomaly_score
    assert not found["c", "Tomates"].found and found["c", "Tomates"].anomaly_score is None
