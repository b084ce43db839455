from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bazaarline.functions.quantiles import group_quantiles
from bazaarline.operators import cleaning as C
from bazaarline.plans import tables
from bazaarline.plans.oracle import OBS, forest_sql, price_forest_sql
from bazaarline.settings import Settings
from check import connect
from conftest import SMALL, months


def series(spark, prices, start=date(2023, 1, 1)):
    rows = [(d, "P", "R", p) for d, p in zip(months(start, len(prices)), prices)]
    return spark.createDataFrame(rows, "date date, product string, region string, price double")


def by_date(df):
    return [r.price for r in df.orderBy("date").collect()]


def test_types_are_coerced(spark):
    df = spark.createDataFrame([("2023-01-01", "100.5"), ("2023-02-01", "  80"), ("x", "1"), ("2023-03-01", "?")], "date string, price string")
    assert sorted(r.price for r in C.standardise_types(df).collect()) == [80.0, 100.5]


def test_future_dates_and_bad_prices_go(spark):
    later = datetime.now() + timedelta(days=90)
    df = spark.createDataFrame(
        [(datetime(2023, 1, 1), 100.0), (later, 200.0), (datetime(2023, 1, 2), -5.0), (datetime(2023, 1, 3), 0.0), (datetime(2023, 1, 4), float("nan"))],
        "date timestamp, price double",
    )
    assert [r.price for r in C.standardise_types(df).collect()] == [100.0]
    assert C.standardise_types(df, keep_missing=True).count() == 2


def test_duplicates(spark, panel):
    one = series(spark, [100.0])
    assert C.drop_exact_duplicates(one.union(one).union(one)).count() == 1
    assert C.drop_exact_duplicates(panel).count() == 240


def test_interpolation_of_gaps(spark):
    assert by_date(C.impute_interpolate(series(spark, [100.0, None, None, 130.0, None, 160.0]))) == pytest.approx([100, 110, 120, 130, 145, 160])
    assert by_date(C.impute_interpolate(series(spark, [None, 100.0, None, None, 130.0, float("nan")]))) == pytest.approx([100, 100, 110, 120, 130, 130])
    assert by_date(C.impute_interpolate(series(spark, [None, None]))) == []


@pytest.mark.parametrize("timed", [False, True])
def test_interpolation_of_raw_rows_with_ties_and_a_hot_group(spark, timed):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(3000):
        product = "hot" if i < 1000 else f"p{i % 7}"
        price = None if rng.random() < 0.4 else float(rng.uniform(1, 100))
        minutes = int(rng.integers(0, 1440)) if timed and i % 2 else 0
        when = datetime(2020, 1, 1) + timedelta(days=int(rng.integers(0, 20)), minutes=minutes)
        rows.append((when, product, "R", f"m{i % 3}", i, price))
    df = spark.createDataFrame(rows, "date timestamp_ntz, product string, region string, market string, id int, price double")
    tie = F.xxhash64("id", "price")
    order = df.select("*", tie.alias("tie"), F.pmod(tie, F.lit(C.SLOTS)).alias("slot")).toPandas()
    order.loc[order["date"].dt.normalize() != order["date"], "slot"] = 0
    order = order.sort_values(["date", "slot", "tie"])
    want = order.groupby(["product", "region", "market"])["price"].transform(
        lambda s: s.interpolate(method="linear").ffill().bfill()
    )
    got = {r.id: r.price for r in C.impute_interpolate(df).collect()}
    expected = dict(zip(order["id"], want))
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in got)


def test_other_imputations(spark):
    assert by_date(C.impute_mean(series(spark, [100.0, 120.0, None, 140.0, 160.0])))[2] == pytest.approx(130)
    assert by_date(C.impute_median(series(spark, [1.0, None, 2.0, 9.0])))[1] == 2.0
    assert C.impute_drop(series(spark, [100.0, None, 120.0, None])).count() == 2
    no_keys = spark.createDataFrame([(1.0,), (None,), (3.0,)], "price double")
    assert sorted(r.price for r in C.impute_mean(no_keys).collect()) == [1.0, 2.0, 3.0]


def test_missing_key_is_not_filled(spark):
    df = spark.createDataFrame([(None, "R", None), (None, "R", 5.0), ("P", "R", 1.0)], "product string, region string, price double")
    assert C.impute_mean(df).count() == 2


@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_spike_goes(spark, panel, clean_rows, method):
    first = clean_rows.iloc[0]
    spike = spark.createDataFrame([(first["date"], first["product"], first["region"], 99_999.0)], panel.schema)
    out = C.remove_outliers(panel.union(spike), method)
    assert out.where("price = 99999").count() == 0 and out.count() >= 235


def test_zscore_edges(spark):
    assert C.outlier_zscore(series(spark, [5.0])).count() == 0
    assert C.outlier_zscore(series(spark, [5.0, 5.0])).count() == 2
    keyless = spark.createDataFrame([(None, "R", 5.0)], "product string, region string, price double")
    assert C.outlier_zscore(keyless).count() == 1 and C.outlier_iqr(keyless).count() == 1


def test_unknown_method_passes_through(spark, panel):
    with pytest.warns(UserWarning, match="unknown outlier method"):
        assert C.remove_outliers(panel, "nothing").count() == 240


def test_quantiles_of_large_and_skewed_groups(spark):
    rng = np.random.default_rng(3)
    values = np.r_[rng.lognormal(3, 2, 30_000), np.full(15_000, 7.0), rng.normal(0, 1, 45)]
    groups = ["hot"] * 30_000 + ["same"] * 15_000 + [f"g{i % 9}" for i in range(45)]
    pdf = pd.DataFrame({"g": groups, "v": values})
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.951, "e": 1.0}
    got = group_quantiles(spark.createDataFrame(pdf).repartition(7), ["g"], "v", probs).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        assert list(got.loc[g, list(probs)]) == pytest.approx(list(np.quantile(part["v"], list(probs.values()))))


def test_isolation_outliers_equal_brute_force(spark):
    """At this scale a tree sees all prices of a group, so SQL can grow the same trees."""
    con = connect(SMALL)
    sql = f"""WITH {OBS}, v AS (SELECT product, region, price, count(*) AS c, price AS x0,
        floor(price * 10000)::BIGINT AS k FROM obs GROUP BY ALL),
      {forest_sql("v", "product, region, x0, c", 1, 100)},
      w AS (SELECT *, sum(c) OVER (PARTITION BY product, region) AS n FROM iso_score),
      r AS (SELECT obs.product, obs.region, obs.price, iso_score, n FROM obs JOIN w ON obs.product = w.product AND obs.region = w.region AND obs.price = w.x0),
      q AS (SELECT product, region, quantile_cont(iso_score, 0.95) AS cut FROM r GROUP BY 1, 2)
      SELECT product, region, price FROM r JOIN q USING (product, region) WHERE n < 10 OR iso_score <= cut + 1e-12"""
    assert con.execute(f"WITH {OBS} SELECT max(c), max(m) FROM (SELECT count(DISTINCT price) AS c, max(k) AS m FROM (SELECT *, count(*) OVER (PARTITION BY product, region, price) AS k FROM obs) GROUP BY product, region)").fetchall()[0][0] <= 256
    want = sorted((a, b, round(c, 6)) for a, b, c in con.execute(sql).fetchall())
    out = C.outlier_isolation(tables.prices(spark, SMALL))
    got = sorted((r.product, r.region, round(r.price, 6)) for r in out.collect())
    assert got == want and len(got) < tables.prices(spark, SMALL).count()


def test_isolation_outliers_of_sampled_trees_equal_sql(spark):
    """Trees that see 16 of a group's prices: sampled, grown and scored alike in SQL."""
    sql = f"""WITH {OBS}, {price_forest_sql(50, 16)},
      r AS (SELECT obs.product, obs.region, obs.price, score, count(*) OVER (PARTITION BY obs.product, obs.region) AS n
        FROM obs JOIN price_score p ON obs.product = p.product AND obs.region = p.region AND obs.price = p.price),
      q AS (SELECT product, region, quantile_cont(score, 0.95) AS cut FROM r GROUP BY 1, 2)
      SELECT product, region, price FROM r JOIN q USING (product, region) WHERE n < 10 OR score <= cut + 1e-12"""
    want = sorted((a, b, round(c, 6)) for a, b, c in connect(SMALL).execute(sql).fetchall())
    rows = tables.prices(spark, SMALL)
    got = sorted((r.product, r.region, round(r.price, 6)) for r in C.outlier_isolation(rows, trees=50, sample=16).collect())
    assert got == want and 0 < len(got) < rows.count()


def test_isolation_outliers_sampled_group(spark):
    rng = np.random.default_rng(5)
    prices = np.r_[rng.normal(100, 5, 4000), [1000.0, 2000.0, 5.0]]
    df = spark.createDataFrame(pd.DataFrame({"product": "P", "region": "R", "price": prices}))
    out = [r.price for r in C.outlier_isolation(df, trees=20).collect()]
    assert not {1000.0, 2000.0, 5.0} & set(out)
    assert 0.94 * len(prices) <= len(out) < len(prices)
    alone = C.outlier_isolation(df.select("price"), trees=20)
    assert 0.94 * len(prices) <= alone.count() < len(prices)


def test_sparse_groups(spark, panel):
    few = series(spark, [1.0, 2.0])
    both = panel.union(few)
    assert C.filter_sparse_groups(both, 10).count() == 240
    assert C.filter_sparse_groups(both.select("price"), 10).count() == 242


def test_clean(spark, panel):
    settings = Settings(min_data_points=10)
    assert C.clean(panel, settings).count() == 240
    blanked = panel.withColumn("price", F.when(F.col("date") > F.lit("2020-05-01"), F.col("price")))
    assert C.clean(blanked, settings).where("price is null").count() == 0
    kept = C.clean(blanked, Settings(min_data_points=10, keep_missing=True))
    assert kept.count() == 240 and kept.where("price is null").count() == 0
    with pytest.raises(ValueError):
        C.clean(panel.where("false"))
    with pytest.raises(ValueError, match="Missing required columns"):
        C.clean(spark.createDataFrame([("2023-01-01", 100)], "date string, value int"))


def test_aggregation(spark, panel):
    out = C.aggregate_monthly(panel)
    assert out.count() == 240 and out.where("price is null").count() == 0
    gap = C.aggregate_monthly(series(spark, [1.0, None, None, 4.0]).where("price is not null"))
    assert [(r.price, r.record_count) for r in gap.orderBy("date").collect()] == [(1.0, 1), (None, 0), (None, 0), (4.0, 1)]
    weeks = C.aggregate_monthly(series(spark, [1.0]), "W").collect()
    assert weeks[0].date == date(2023, 1, 1)


def test_counts_per_step(spark, panel):
    odd = panel.union(panel.limit(7)).union(series(spark, [-1.0, 50.0]).select(panel.columns))
    steps = {}
    out = C.clean(odd, Settings(outlier_method="zscore"), steps=steps)
    n = len(out.collect())
    assert {k: v.get["n"] for k, v in steps.items()} == {"types": 248, "duplicates": 241, "outliers": 240, "sparse groups": n} and n == 240


def test_missed_bracket_raises(spark, monkeypatch):
    from bazaarline.functions import quantiles

    monkeypatch.setattr(quantiles, "SMALL", 10)
    monkeypatch.setattr(quantiles, "MARGIN", -0.4)
    rows = spark.range(500).select(F.lit("g").alias("k"), F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="missed its rank"):
        group_quantiles(rows, ["k"], "v", {"m": 0.5}).collect()


def test_skew_of_an_isolation_group_can_be_split(spark):
    """A hot group's rows meet its forest in a join that adaptive execution splits."""
    from bazaarline.operators.isolation import add_isolation_score, fit_forest
    from bazaarline.functions.staging import stage

    hot = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string")))
    rows = stage(spark.range(200_000).select(hot.alias("g"), (F.col("id") % 9973).cast("double").alias("price"), F.col("id").cast("string").alias("text")))
    forest = stage(fit_forest(rows, ["g"], ["price"], F.col("text"), trees=10))
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        scored = add_isolation_score(rows, forest, ["g"], ["price"], "s")
        assert len(scored.select("s").collect()) == 200_000
        assert "skew=true" in scored.select("s")._jdf.queryExecution().toString() or "skew=true" in final_plan(scored)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def final_plan(df):
    made = df.select("s")
    made._jdf.queryExecution().executedPlan().executeCollectPublic()
    return made._jdf.queryExecution().executedPlan().toString()


def test_one_feature_is_scored_by_steps_without_the_forest(spark):
    """Equal to the walk down the trees, bit for bit; what a row meets is a block of steps."""
    from bazaarline.operators import isolation as I
    from bazaarline.functions.staging import stage

    value = F.when(F.col("id") % 3 > 0, F.xxhash64("id") % 5000 / 7.0).otherwise(F.col("id") % 11 + 0.5)
    rows = stage(spark.range(4000).select(F.when(F.col("id") > 2, "hot").otherwise("few").alias("g"), value.alias("x"), F.col("id").cast("string").alias("text")))
    forest = stage(I.fit_forest(rows, ["g"], ["x"], F.col("text"), trees=30))
    odd = [("hot", v) for v in (None, float("nan"), float("inf"), -float("inf"), -1e9, 0.5)] + [("few", None), ("few", 3.0), ("none", 1.0), (None, 1.0)]
    asked = rows.select("g", "x").unionByName(spark.createDataFrame(odd, "g string, x double"))
    nodes = forest.withColumnsRenamed({"forest": "f", "psi": "p"})
    walked = asked.join(nodes, ["g"], "left").select("g", "x", I.isolation(F.array("x"), F.col("f"), F.col("p")).alias("s"))
    scored = I.add_isolation_score(asked, forest, ["g"], ["x"], "s")
    plain = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert plain(scored) == plain(walked) and scored.where("s is null").count() == 2
    plan = scored._jdf.queryExecution().analyzed().toString()
    assert "forest" not in plan and "_depth" in plan


@pytest.mark.parametrize("n", [1, 20, 256, 300, 5000])
def test_drawn_trees_are_all_whose_stretch_holds_the_hash(spark, n):
    from bazaarline.functions.scalars import hash_unit
    from bazaarline.operators.isolation import _draw

    rows = spark.range(n).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("text"))
    got = {r.text: sorted(r._trees) for r in _draw(rows, ["g"], F.col("text"), 100, 7, None, 256).collect()}
    hashes = rows.select("text", hash_unit(F.concat_ws("|", F.lit("7"), "g", "text")).alias("u")).collect()
    want = {r.text: [t for t in range(100) if 256 / n >= 1 or (r.u + t / 100.0) % 1.0 < 256 / n] for r in hashes}
    assert got == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("full, chunks", [(10_000, (9, 9)), (60, (150, 2600))])
def test_interpolation_cuts_only_full_spans_and_days(spark, monkeypatch, full, chunks):
    """A sparse series has a chunk per span of days; a hot one is cut into days and slots."""
    rng, rows = np.random.default_rng(4), []
    for i in range(2400):
        hot = i < 1500
        day = 3 if i < 400 else int(rng.integers(0, 45 if hot else 160))
        minutes = int(rng.integers(0, 1440)) if i % 2 else 0
        when = datetime(1970, 1, 1) + timedelta(days=day, minutes=minutes)
        price = None if rng.random() < 0.5 else float(rng.uniform(1, 100))
        rows.append((when, "hot" if hot else f"p{i % 3}", "R", "m", i, price))
    if full == 10_000:
        rows = [r for r in rows if r[1] != "hot"]
    staged, plain = {}, C.stage
    monkeypatch.setattr(C, "stage", lambda df, name="stage": staged.setdefault(name, plain(df, name)))
    monkeypatch.setattr(C, "FULL", full)
    df = spark.createDataFrame(rows, "date timestamp_ntz, product string, region string, market string, id int, price double")
    got = {r.id: r.price for r in C.impute_interpolate(df, F.col("id")).collect()}
    pdf = df.toPandas()
    second = pdf["date"].dt.hour * 3600 + pdf["date"].dt.minute * 60
    pdf["day"] = pdf["date"].dt.normalize()
    pdf["place"] = np.where(second == 0, pdf["id"] % C.SLOTS, C.SLOTS + second * C.SLOTS // 86400)
    pdf = pdf.sort_values(["day", "place", "date", "id"])
    want = pdf.groupby("product")["price"].transform(lambda s: s.interpolate(method="linear").ffill().bfill())
    assert got == pytest.approx(dict(zip(pdf["id"], want)))
    assert chunks[0] <= staged["borders"].count() <= chunks[1]
    assert (staged["full-spans"].count() > 0) == (full == 60)
