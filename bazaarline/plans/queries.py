"""The registered queries: every operator on the whole of the given tables.

Figures are snapped to four digits so that they do not depend on the order of
summation; nothing else is done to an operator's result.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import BOARD_RAMADAN, HOLIDAYS, RAMADAN, SEASONS_FR, add_temporal_features, is_ramadan, season
from ..functions.events import add_event_flag, add_yearly_flag
from ..functions.scalars import format_price, signed_percent, snap
from ..functions.staging import new_path, spread, stage
from ..operators import analytics, anomaly, boundary, changepoints, chunks, cleaning, features, forecast, gram, isolation, names, recurrent, window_model
from ..sources import dimensions, incremental, readers, sinks, validate
from . import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def snapped(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles as fixed-point values, timestamps of days as dates."""
    out = []
    for name, kind in df.dtypes:
        if kind == "double":
            out.append(snap(F.col(name), digits).alias(name))
        elif kind.startswith("timestamp"):
            out.append(F.to_date(name).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


# ---- sources and sinks -------------------------------------------------------


def _market_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.observations(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("region").alias("admin1"),
        F.col("market").alias("admin2"),
        "market",
        "latitude",
        "longitude",
        "category",
        F.col("product").alias("commodity"),
        F.lit("kg").alias("unit"),
        F.lit("actual").alias("priceflag"),
        F.lit("Retail").alias("pricetype"),
        F.lit("DZD").alias("currency"),
        "price",
        F.col("price_usd").alias("usdprice"),
    )


@query
def scan_csv(spark, sf_dir):
    path = new_path(spark, "csv")
    sinks.write_csv(_market_file(spark, sf_dir), path)
    rows = readers.standardise_source(readers.scan_csv(spark, path))
    return snapped(rows.select("date", "region", "district", "market", "category", "product", "unit", "price", "price_usd"))


def _producer_records(spark, sf_dir):
    return (
        tables.observations(spark, sf_dir)
        .groupBy(F.col("market").alias("area"), F.col("product").alias("item"), F.year("date").alias("year"))
        .agg(snap(F.avg("price")).alias("value"))
        .select(
            "area",
            F.regexp_replace("area", "NATION_", "").alias("area_code"),
            "item",
            F.regexp_replace("item", "Brand#", "").alias("item_code"),
            F.lit("Producer Price").alias("element"),
            "year",
            F.lit("DZD/kg").alias("unit"),
            "value",
            F.lit("A").alias("flag"),
        )
    )


@query
def scan_json(spark, sf_dir):
    path = new_path(spark, "json")
    record = F.array(F.struct("*")).alias("data")
    _producer_records(spark, sf_dir).select(record).write.json(path)
    return readers.scan_json(spark, path, (1996, 1999), ["3", "7", "12", "21"])


@query
def scan_food_balance(spark, sf_dir):
    path = new_path(spark, "json")
    lines = tables.read(spark, sf_dir, "lineitem").join(
        tables.read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    supply = lines.groupBy(F.col("p_type").alias("item"), F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").alias("value")
    )
    record = F.array(F.struct("item", F.lit("Supply").alias("element"), "year", F.lit("t").alias("unit"), "value"))
    supply.select(record.alias("data")).write.json(path)
    return readers.scan_food_balance(spark, path, (1996, 2000)).select("item", "element", "year", "unit", "value")


@query
def normalise_columns(spark, sf_dir):
    text = F.when(F.col("order_key") % 11 == 0, "n/a").otherwise(F.col("price").cast("string"))
    raw = tables.observations(spark, sf_dir).select(
        F.col("product").alias("Item Name"), F.col("region").alias("Area - Code"), F.col("date").alias("-Ship  Date-"), text.alias("Value")
    )
    return snapped(readers.normalise_columns(raw))


@query
def standardise_source(spark, sf_dir):
    key = F.col("order_key")
    raw = tables.observations(spark, sf_dir).select(
        F.when(key % 13 == 0, "bad").otherwise(F.date_format("date", "yyyy-MM-dd")).alias(" Date "),
        F.col("region").alias("ADMIN1"),
        F.col("market").alias("Admin2"),
        F.col("category").alias("Category"),
        F.col("product").alias("Commodity"),
        F.when(key % 11 == 0, "n/a").otherwise(F.col("price").cast("string")).alias("Price"),
        F.col("price_usd").cast("string").alias("USDprice"),
        F.lit(0.0).alias("price "),
        F.lit("x").alias("remark"),
    )
    return snapped(readers.standardise_source(raw))


@query
def priority_union(spark, sf_dir):
    rows = tables.prices(spark, sf_dir)
    real = rows.where(F.col("region").isin("ASIA", "EUROPE"))
    return snapped(readers.priority_union(real, rows.withColumn("price", F.col("price") * 0.5)))


@query
def market_locations(spark, sf_dir):
    return snapped(readers.market_locations(tables.observations(spark, sf_dir)))


@query
def write_parquet(spark, sf_dir):
    path = new_path(spark, "panel")
    sinks.write_parquet(tables.panel(spark, sf_dir), path, ["product"])
    back = readers.read_parquet_safe(spark, path)
    return snapped(back.select("product", "region", "date", "price", "record_count"))


@query
def write_csv(spark, sf_dir):
    path = new_path(spark, "alerts")
    sinks.write_csv(tables.known_panel(spark, sf_dir), path)
    back = readers.scan_csv(spark, path, "product string, region string, date date, price double")
    return snapped(back)


@query
def materialise_or_reuse(spark, sf_dir):
    path = new_path(spark, "features")
    build = lambda: tables.known_panel(spark, sf_dir)
    readers.materialise_or_reuse(spark, path, build)
    return snapped(readers.materialise_or_reuse(spark, path, build))


@query
def validate_table(spark, sf_dir):
    """Verdicts on tables as they are, without rows, without a column, and against the size of another."""
    customers = tables.read(spark, sf_dir, "customer")
    cases = [
        ("observations", tables.observations(spark, sf_dir), ["date", "product", "region", "price"], customers.count()),
        ("late", tables.observations(spark, sf_dir).where("date > '2100-01-01'"), ["date"], 1),
        ("no altitude", tables.panel(spark, sf_dir), ["price", "altitude", "slope"], 1),
        ("suppliers", tables.read(spark, sf_dir, "supplier"), ["s_suppkey"], customers.count() + 1),
        ("regions", tables.read(spark, sf_dir, "region"), ["r_name"], 1000),
    ]
    return spark.createDataFrame([(name, _verdict(*case)) for name, *case in cases], "name string, verdict string")


def _verdict(df, required, min_rows):
    try:
        return str(validate.validate_table(df, required, min_rows)).lower()
    except ValueError as error:
        return str(error)


@query
def dimension_ranges(spark, sf_dir):
    """Prices inside and outside a typical range kept as an array in the product dimension."""
    products = (
        tables.read(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("product"))
        .agg(F.array(F.min("p_retailprice"), F.max("p_retailprice")).alias("typical_price_range"))
    )
    rows = dimensions.with_typical_range(tables.prices(spark, sf_dir), products)
    return rows.groupBy("product").agg(
        F.count_if("in_range").alias("n_inside"), F.count_if(~F.col("in_range")).alias("n_outside")
    )


def _named(spark, sf_dir, column, names):
    """Prices with a dimension's names in place of the numbered ones of the table."""
    numbers = tables.observations(spark, sf_dir).withColumn("_n", F.pmod(F.col("order_key"), F.lit(len(names) + 1)) + 1)
    return numbers.withColumn(column, F.try_element_at(F.array(*map(F.lit, names)), F.col("_n").cast("int")))


@query
def region_dimension(spark, sf_dir):
    """Rows and mean price by province of the region dimension; one name is unknown to it."""
    names = [r[0] for r in dimensions.REGIONS]
    rows = _named(spark, sf_dir, "region", names)
    joined = rows.select("region", "price").join(dimensions.region_dimension(spark), "region", "left")
    return snapped(joined.groupBy("region", "code", "province", "latitude").agg(F.count("*").alias("n_rows"), F.avg("price").alias("price")))


@query
def product_dimension(spark, sf_dir):
    """Prices inside the typical range by product of the product dimension."""
    rows = _named(spark, sf_dir, "product", [p[1] for p in dimensions.PRODUCTS])
    found = dimensions.with_typical_range(rows.select("product", "price"), dimensions.product_dimension(spark))
    units = dimensions.product_dimension(spark).select("product", "category", "unit")
    return found.join(units, "product", "left").groupBy("product", "category", "unit").agg(
        F.count("*").alias("n_rows"), F.count_if("in_range").alias("n_inside")
    )


@query
def board_regions(spark, sf_dir):
    """Mean price at the map coordinates of the board's regions."""
    rows = _named(spark, sf_dir, "region", [r[0] for r in dimensions.BOARD_REGIONS]).select("region", "price")
    joined = rows.join(dimensions.board_regions(spark), "region")
    return snapped(joined.groupBy("region", "latitude", "longitude").agg(F.avg("price").alias("price")))


# ---- cleaning ----------------------------------------------------------------

AS_OF = date(2001, 6, 30)


@query
def standardise_types(spark, sf_dir):
    sign = F.when(F.col("order_key") % 17 == 0, -1).otherwise(1)
    raw = tables.observations(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "product",
        "region",
        F.concat(F.lit("  "), (F.col("price") * sign).cast("string")).alias("price"),
        F.when(F.col("order_key") % 19 == 0, "?").otherwise(F.col("price_usd").cast("string")).alias("price_usd"),
    )
    return snapped(cleaning.standardise_types(raw, F.lit(AS_OF)))


@query
def drop_exact_duplicates(spark, sf_dir):
    rows = tables.observations(spark, sf_dir)
    return snapped(cleaning.drop_exact_duplicates(rows.union(rows.where("order_key % 5 = 0"))))


@query
def impute_interpolate(spark, sf_dir):
    return snapped(cleaning.impute_interpolate(tables.gap_panel(spark, sf_dir)))


@query
def impute_interpolate_rows(spark, sf_dir):
    """Raw rows: many of a market share a day, and are then ordered by their order key."""
    rows = tables.observations(spark, sf_dir)
    blank = F.col("order_key") % 7 == 0
    rows = rows.select(
        "date", "product", "region", "market", "order_key", F.when(~blank, F.col("price")).alias("price")
    )
    return snapped(cleaning.impute_interpolate(rows, F.col("order_key")))


@query
def impute_mean(spark, sf_dir):
    return snapped(cleaning.impute_mean(tables.gap_rows(spark, sf_dir)))


@query
def impute_median(spark, sf_dir):
    return snapped(cleaning.impute_median(tables.gap_rows(spark, sf_dir)))


@query
def impute_drop(spark, sf_dir):
    return snapped(cleaning.impute_drop(tables.gap_rows(spark, sf_dir)))


@query
def outlier_iqr(spark, sf_dir):
    return snapped(cleaning.outlier_iqr(tables.prices(spark, sf_dir)))


@query
def outlier_zscore(spark, sf_dir):
    return snapped(cleaning.outlier_zscore(tables.prices(spark, sf_dir)))


@query
def outlier_dispatch(spark, sf_dir):
    """What each method leaves of every series; the last name is unknown and removes nothing."""
    rows, left = tables.prices(spark, sf_dir), []
    for method, threshold in (("iqr", 0.5), ("zscore", 1.5), ("unheard-of", 3.0)):
        kept = cleaning.remove_outliers(rows, method, threshold)
        figures = [F.count("*").alias("n_rows"), F.avg("price").alias("price")]
        left.append(kept.groupBy("product", "region").agg(*figures).withColumn("method", F.lit(method)))
    return snapped(reduce(DataFrame.unionByName, left))


@query
def outlier_isolation(spark, sf_dir):
    return snapped(cleaning.outlier_isolation(tables.prices(spark, sf_dir)))


@query
def filter_sparse_groups(spark, sf_dir):
    """The threshold is the mean size of a group, so that some go."""
    rows = tables.prices(spark, sf_dir)
    sizes = rows.groupBy(*cleaning.GROUP).count()
    return snapped(cleaning.filter_sparse_groups(rows, sizes.agg(F.avg("count")).scalar()))


@query
def clean_prices(spark, sf_dir):
    rows = tables.observations(spark, sf_dir).select("date", "product", "region", "market", "price", "price_usd")
    return snapped(cleaning.clean(rows, as_of=F.lit(AS_OF)))


@query
def aggregate_monthly(spark, sf_dir):
    return snapped(tables.panel(spark, sf_dir))


@query
def incremental_panel(spark, sf_dir):
    """Built from some files, one of them with other prices; then the rest comes and that one is replaced."""
    source, state = new_path(spark, "prices"), new_path(spark, "state")
    rows = tables.observations(spark, sf_dir).select("date", "product", "region", "price", (F.col("order_key") % 4).alias("kind"))
    other = rows.where("kind = 1").withColumn("price", F.col("price") * 3)
    write = lambda df, mode, part: df.drop("kind").write.mode(mode).parquet(f"{source}/part={part}")
    write(rows.where("kind = 0"), "error", 0)
    write(other, "error", 1)
    incremental.refresh(spark, source, state)
    write(rows.where("kind = 1"), "overwrite", 1)
    write(rows.where("kind >= 2"), "error", 2)
    incremental.refresh(spark, source, state)
    return snapped(incremental.panel(spark, state))


def _periods(freq: str) -> Query:
    return lambda spark, sf_dir: snapped(cleaning.aggregate_monthly(tables.prices(spark, sf_dir), freq))


for _name, _freq in (("daily", "D"), ("weekly", "W"), ("quarterly", "QS"), ("yearly", "YS")):
    QUERIES[f"aggregate_{_name}"] = _periods(_freq)


# ---- calendar and features ---------------------------------------------------


def _shifted(spark, sf_dir, months):
    """Daily prices moved into the years that the calendars cover."""
    rows = tables.prices(spark, sf_dir).withColumn("date", F.add_months(F.to_date("date"), months))
    return rows.groupBy("product", "date").agg(F.avg("price").alias("price"))


@query
def temporal_features(spark, sf_dir):
    return snapped(add_temporal_features(_shifted(spark, sf_dir, 300)))


@query
def event_flags(spark, sf_dir):
    """The calendar flags of every observation's day, from tables of events."""
    rows = _shifted(spark, sf_dir, 300).select("product", "date", "price")
    spans = spark.createDataFrame([(date.fromisoformat(a), date.fromisoformat(b)) for a, b in RAMADAN.values()], "start date, end date")
    days = spark.createDataFrame(HOLIDAYS, "month int, day int")
    return snapped(add_yearly_flag(add_event_flag(rows, spans, "is_ramadan"), days, "is_holiday"))


@query
def ramadan_board(spark, sf_dir):
    day = F.col("date")
    rows = _shifted(spark, sf_dir, 240)
    return snapped(rows.select("product", "date", "price", is_ramadan(day, BOARD_RAMADAN).alias("is_ramadan"), season(day, SEASONS_FR).alias("season")))


def _on_panel(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: snapped(
        tables.panel(spark, sf_dir).drop("price_std", "record_count").transform(step)
    )


QUERIES["lag_features"] = _on_panel(features.lag_features)
QUERIES["rolling_features"] = _on_panel(features.rolling_features)
QUERIES["pct_change_features"] = _on_panel(features.pct_change_features)
QUERIES["price_vs_national"] = _on_panel(features.price_vs_national)
QUERIES["normalise_minmax"] = _on_panel(lambda df: features.normalise(df, "minmax"))
QUERIES["normalise_standard"] = _on_panel(lambda df: features.normalise(df, "standard"))
QUERIES["normalise_robust"] = _on_panel(lambda df: features.normalise(df, "robust"))
QUERIES["normalise_unknown"] = _on_panel(lambda df: features.normalise(df, "unheard-of"))
QUERIES["simple_features"] = _on_panel(features.simple_features)
QUERIES["build_features"] = _on_panel(features.build_features)


def _on_days(step: Callable[[DataFrame], DataFrame]) -> Query:
    """On the daily panel, in chunks that are far shorter than its series."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        days = cleaning.aggregate_monthly(tables.prices(spark, sf_dir), "D")
        return snapped(step(stage(days.drop("price_std", "record_count"), "days")))

    return run


QUERIES["long_lags"] = _on_days(lambda df: chunks.long_lags(df, days=300))
QUERIES["long_rolling"] = _on_days(lambda df: chunks.long_rolling(df, days=300))
QUERIES["long_changes"] = _on_days(lambda df: chunks.long_changes(df, days=300))
QUERIES["long_national"] = _on_days(chunks.long_national)
QUERIES["long_normalise_minmax"] = _on_days(lambda df: chunks.long_normalise(df, "minmax"))
QUERIES["long_normalise_robust"] = _on_days(lambda df: chunks.long_normalise(df, "robust"))
QUERIES["long_features"] = _on_days(lambda df: chunks.build_long_features(df, days=300))


@query
def long_detection(spark, sf_dir):
    days = cleaning.aggregate_monthly(tables.prices(spark, sf_dir), "D").where("price is not null")
    return snapped(chunks.long_detection(stage(days.select("product", "region", "date", "price"), "days"), days=300))


@query
def long_normalise_score(spark, sf_dir):
    days = cleaning.aggregate_monthly(tables.prices(spark, sf_dir), "D").where("price is not null")
    days = stage(days.select("product", "region", "date", "price"), "days")
    return snapped(chunks.long_normalise_score(days, "price").drop("price"))


@query
def inverse_normalise(spark, sf_dir):
    known = stage(tables.known_panel(spark, sf_dir), "panel")
    normal = features.normalise(known, "standard").drop("price")
    return snapped(features.inverse_normalise(normal, features.scaler_parameters(known, "standard")))


@query
def build_sequences(spark, sf_dir):
    rows = features.build_features(tables.panel(spark, sf_dir).drop("price_std", "record_count"))
    windows = features.build_sequences(rows, 60)
    total = F.aggregate(F.flatten("x"), F.lit(0.0), lambda a, v: a + v)
    return snapped(
        windows.select(
            "product", "region", "date", "y",
            F.size("x").cast("bigint").alias("steps"),
            F.get(F.get("x", F.lit(0)), F.lit(0)).alias("first_target"),
            F.get(F.get("x", F.lit(59)), F.lit(5)).alias("last_change"),
            total.alias("total"),
        )
    )


# ---- anomalies ---------------------------------------------------------------


@query
def detection_features(spark, sf_dir):
    return snapped(anomaly.detection_features(tables.known_panel(spark, sf_dir)))


@query
def scale_features(spark, sf_dir):
    scaled = anomaly.scaled_training_rows(tables.known_panel(spark, sf_dir))
    return snapped(scaled.select("product", "region", "date", *anomaly.SCALED))


def _training(spark, sf_dir):
    rows = anomaly.scaled_training_rows(spread(tables.known_panel(spark, sf_dir), *anomaly.GROUP))
    return stage(rows.select("product", "region", "date", *anomaly.SCALED), "training")


@query
def isolation_score(spark, sf_dir):
    rows = _training(spark, sf_dir)
    forest = stage(isolation.fit_forest(rows, anomaly.GROUP, anomaly.SCALED, anomaly.day_label()), "forest")
    scored = isolation.add_isolation_score(spread(rows, *anomaly.GROUP), forest, anomaly.GROUP, anomaly.SCALED, "score")
    return snapped(scored.select("product", "region", "date", "score"))


@query
def boundary_score(spark, sf_dir):
    rows = _training(spark, sf_dir)
    means = stage(boundary.fit_boundary(rows, anomaly.GROUP, anomaly.SCALED), "boundary")
    scored = boundary.add_similarity(spread(rows, *anomaly.GROUP), means, anomaly.GROUP, anomaly.SCALED, "score")
    return snapped(scored.select("product", "region", "date", "score"))


@query
def boundary_score_nu(spark, sf_dir):
    """The one-class boundary that leaves about a twentieth of a series outside."""
    rows = _training(spark, sf_dir)
    solved = stage(boundary.fit_boundary(rows, anomaly.GROUP, anomaly.SCALED, nu=0.05), "boundary")
    scored = boundary.add_similarity(spread(rows, *anomaly.GROUP), solved, anomaly.GROUP, anomaly.SCALED, "score")
    marked = scored.join(solved.select(*anomaly.GROUP, "offset"), anomaly.GROUP)
    outside = F.col("score") < F.col("offset") - boundary.MARGIN
    return snapped(marked.select("product", "region", "date", "score", "offset", outside.alias("outside")), 3)


@query
def normalise_score(spark, sf_dir):
    rows = tables.known_panel(spark, sf_dir)
    return snapped(rows.select("product", "region", "date", anomaly.normalise_score(F.col("price")).alias("score")))


@query
def composite_score(spark, sf_dir):
    series = lambda c: anomaly.normalise_score(c)
    rows = tables.known_panel(spark, sf_dir).withColumns(
        {"if_score": series(F.col("price")), "svm_score": series(-F.col("price"))}
    )
    rows = rows.withColumn("svm_score", F.col("svm_score") * F.col("svm_score"))
    return snapped(anomaly.composite_score(rows, 0.45))


@query
def score_panel(spark, sf_dir):
    return snapped(anomaly.score_panel(stage(tables.known_panel(spark, sf_dir), "panel")))


@query
def score_repeated_rows(spark, sf_dir):
    """Some months stand twice in the panel; every row keeps its score."""
    rows = stage(tables.known_panel(spark, sf_dir), "panel")
    return snapped(anomaly.score_panel(rows.unionByName(rows.where(F.month("date") % 5 == 0))))


@query
def severity(spark, sf_dir):
    rows = tables.scored_panel(spark, sf_dir)
    score = F.col("anomaly_score")
    return snapped(
        rows.select("product", "region", "date", "anomaly_score", anomaly.severity(score).alias("severity"),
                    anomaly.severity(score, anomaly.SEVERITIES_FR).alias("label"))
    )


@query
def generate_alerts(spark, sf_dir):
    alerts = anomaly.generate_alerts(tables.scored_panel(spark, sf_dir)).drop("message")
    return snapped(alerts)


@query
def alert_message(spark, sf_dir):
    alerts = anomaly.generate_alerts(tables.scored_panel(spark, sf_dir))
    return alerts.select("product", "region", "date", "message")


@query
def detector_params_io(spark, sf_dir):
    rows = stage(tables.known_panel(spark, sf_dir), "panel")
    path = new_path(spark, "detector")
    anomaly.save_detector(anomaly.fit_detector(rows), path, 0.8)
    return snapped(anomaly.predict(rows, anomaly.load_detector(spark, path)))


@query
def score_new_observations(spark, sf_dir):
    """Two prices for every series: twice its last price, and its first price again."""
    history = stage(tables.known_panel(spark, sf_dir), "panel")
    ends = history.groupBy("product", "region").agg(
        F.max("date").alias("last"), F.max_by("price", "date").alias("last_price"), F.min_by("price", "date").alias("first_price")
    )
    new = ends.select(
        "product", "region",
        F.explode(
            F.array(
                F.struct(F.lit("a").alias("tag"), F.add_months("last", 1).alias("date"), (F.col("last_price") * 2).alias("price")),
                F.struct(F.lit("b").alias("tag"), F.add_months("last", -10).alias("date"), F.col("first_price").alias("price")),
            )
        ).alias("n"),
    ).select(F.concat_ws("/", "product", "region", "n.tag").alias("obs_id"), "product", "region", "n.date", "n.price")
    unknown = new.where("region = 'ASIA'").select(
        F.concat("obs_id", F.lit("?")).alias("obs_id"), "product", F.lit("NOWHERE").alias("region"), "date", "price"
    )
    detector = anomaly.fit_detector(history)
    return snapped(anomaly.score_new_observations(history, new.union(unknown), detector))


@query
def isolation_score_simple(spark, sf_dir):
    rows = features.simple_features(tables.known_panel(spark, sf_dir))
    return snapped(anomaly.isolation_score_simple(rows).drop("pct_change_12m"))


@query
def anomaly_summary(spark, sf_dir):
    return snapped(anomaly.anomaly_summary(tables.scored_panel(spark, sf_dir)))


@query
def anomalies_by_product(spark, sf_dir):
    return anomaly.anomalies_by_product(tables.scored_panel(spark, sf_dir))


@query
def severity_counts(spark, sf_dir):
    return anomaly.severity_counts(anomaly.generate_alerts(tables.scored_panel(spark, sf_dir)))


@query
def alert_bands(spark, sf_dir):
    return anomaly.alert_bands(tables.scored_panel(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return anomaly.score_histogram(snapped(tables.scored_panel(spark, sf_dir), 6))


# ---- forecasts ---------------------------------------------------------------


def _known(spark, sf_dir):
    return tables.known_panel(spark, sf_dir)


@query
def forecast_seasonal_trend(spark, sf_dir):
    return snapped(forecast.forecast_seasonal_trend(_known(spark, sf_dir)))


@query
def forecast_seasonal_events(spark, sf_dir):
    """With the Ramadan and holiday effect, on years that the calendar covers."""
    moved = _known(spark, sf_dir).withColumn("date", F.add_months("date", 300))
    return snapped(forecast.forecast_seasonal_trend(moved, 12, 0.90, events=True))


@query
def forecast_autoregressive(spark, sf_dir):
    return snapped(forecast.forecast_autoregressive(_known(spark, sf_dir)))


@query
def forecast_window_regression(spark, sf_dir):
    rows = stage(features.build_features(_known(spark, sf_dir)), "features")
    return snapped(window_model.forecast_window_regression(rows))


@query
def forecast_recurrent(spark, sf_dir):
    rows = stage(features.build_features(_known(spark, sf_dir)), "features")
    return snapped(recurrent.forecast_recurrent(rows))


@query
def forecast_ensemble(spark, sf_dir):
    return snapped(forecast.forecast_ensemble(_known(spark, sf_dir)))


@query
def forecast_changepoints(spark, sf_dir):
    return snapped(changepoints.forecast_changepoints(_known(spark, sf_dir)), 3)


@query
def trend_changes(spark, sf_dir):
    """Additive, with the Ramadan and holiday terms, on years that the calendar covers."""
    moved = _known(spark, sf_dir).withColumn("date", F.add_months("date", 300))
    bends = changepoints.Bends(changes=4, harmonics=2, multiplicative=False, events=True)
    return snapped(changepoints.trend_changes(changepoints.fit_changepoints(moved, bends), bends), 3)


@query
def evaluate_changepoints(spark, sf_dir):
    return snapped(changepoints.evaluate_changepoints(_known(spark, sf_dir)), 3)


@query
def fit_gate(spark, sf_dir):
    return snapped(forecast.fit_gate(_known(spark, sf_dir), 80))


@query
def skipped_series(spark, sf_dir):
    return forecast.skipped_series(_known(spark, sf_dir), 80)


@query
def future_calendar(spark, sf_dir):
    return forecast.future_calendar(_known(spark, sf_dir), 24)


@query
def forecast_quadratic(spark, sf_dir):
    return snapped(forecast.forecast_quadratic(_known(spark, sf_dir)))


@query
def holdout_split(spark, sf_dir):
    return snapped(forecast.holdout_split(_known(spark, sf_dir)))


@query
def metrics(spark, sf_dir):
    """The price a month before taken as the prediction."""
    rows = features.lag_features(_known(spark, sf_dir), (1,)).where("lag_price_1m is not null")
    return snapped(forecast.metrics(rows, "price", "lag_price_1m", ["product", "region"]))


@query
def evaluate_forecasts(spark, sf_dir):
    return snapped(forecast.evaluate_forecasts(_known(spark, sf_dir)))


@query
def best_match(spark, sf_dir):
    names = tables.read(spark, sf_dir, "part").select(F.col("p_brand").alias("name"))
    exact = forecast.best_match(names, "brand#7").select(F.lit("brand#7").alias("requested"), "name")
    inside = forecast.best_match(names, "AND#2").select(F.lit("AND#2").alias("requested"), "name")
    around = forecast.best_match(names, "the brand#14 price").select(F.lit("the brand#14 price").alias("requested"), "name")
    none = forecast.best_match(names, "tomates").select(F.lit("tomates").alias("requested"), "name")
    return exact.union(inside).union(around).union(none)


@query
def best_matches(spark, sf_dir):
    """Every part's type, and pieces of it, asked for among all brands, types and nations."""
    read = lambda name, column: tables.read(spark, sf_dir, name).select(F.col(column).alias("name"))
    known = read("part", "p_type").unionByName(read("part", "p_brand")).unionByName(read("nation", "n_name"))
    part = tables.read(spark, sf_dir, "part")
    forms = F.array(
        F.lower("p_type"), F.substring("p_type", 3, 6), F.concat(F.lit("the "), "p_brand", F.lit(" of "), F.col("p_partkey").cast("string")),
        F.substring("p_brand", 6, 2), F.right("p_name", F.lit(4)),
    )
    return names.best_matches(known, part.select(F.explode(forms).alias("requested")))


@query
def pick_best_series(spark, sf_dir):
    return forecast.pick_best_series(_known(spark, sf_dir), "brand#7", "asi").union(
        forecast.pick_best_series(_known(spark, sf_dir), "Tomates", "Alger")
    )


@query
def denormalise_forecast(spark, sf_dir):
    known = _known(spark, sf_dir)
    ahead = forecast.forecast_autoregressive(known).withColumn("yhat", F.col("yhat") / 1000)
    return snapped(forecast.denormalise_forecast(ahead, known))


@query
def forecast_params_io(spark, sf_dir):
    rows = forecast.fit_gate(_known(spark, sf_dir))
    path = new_path(spark, "trend")
    sinks.write_parquet(forecast.fit_seasonal_trend(rows), path)
    return snapped(forecast.predict_seasonal_trend(spark.read.parquet(path), 6, 0.90))


@query
def future_only(spark, sf_dir):
    """Forecast made on the first 80 % of each series, cut at the end of the whole."""
    known = _known(spark, sf_dir)
    train = forecast.holdout_split(known).where("part = 'train'").drop("part", "step")
    return snapped(forecast.future_only(forecast.forecast_quadratic(train, 24), known))


@query
def last_steps(spark, sf_dir):
    ahead = forecast.forecast_autoregressive(_known(spark, sf_dir), 24)
    return snapped(forecast.last_steps(ahead, 6, 2))


# ---- reports -----------------------------------------------------------------


@query
def list_products(spark, sf_dir):
    return analytics.distinct_values(tables.observations(spark, sf_dir), "product")


@query
def list_regions(spark, sf_dir):
    return analytics.distinct_values(tables.observations(spark, sf_dir), "region")


@query
def list_categories(spark, sf_dir):
    return analytics.distinct_values(tables.observations(spark, sf_dir), "category")


@query
def query_prices(spark, sf_dir):
    rows = tables.known_panel(spark, sf_dir)
    return snapped(analytics.query_prices(rows, "Brand#7", "ASIA", date(1996, 1, 1), date(2000, 12, 31), 100))


@query
def query_alerts(spark, sf_dir):
    alerts = anomaly.generate_alerts(tables.scored_panel(spark, sf_dir)).drop("message")
    return snapped(analytics.query_alerts(alerts, "low", region="ASIA"))


@query
def filter_panel(spark, sf_dir):
    rows = tables.observations(spark, sf_dir).select("date", "product", "region", "category", "price")
    return snapped(
        analytics.filter_panel(rows, ["Brand#1", "Brand#2", "Brand#3"], ["ASIA", "EUROPE"],
                               date(1997, 1, 1), date(1999, 12, 31), ["ECONOMY", "STANDARD", "PROMO"])
    )


@query
def kpi_summary(spark, sf_dir):
    return snapped(analytics.kpi_summary(tables.scored_panel(spark, sf_dir)))


@query
def map_latest(spark, sf_dir):
    return snapped(analytics.map_latest(tables.observations(spark, sf_dir), "Brand#7"))


@query
def map_with_missing_regions(spark, sf_dir):
    """Markets of one brand in its newest month, with the nations it lacks there."""
    rows = tables.observations(spark, sf_dir).withColumn("region", F.col("market"))
    rows = rows.withColumn("date", F.trunc("date", "month"))
    points = stage(analytics.map_latest(rows, "Brand#7"), "points")
    nations = tables.read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("region"), (F.col("n_nationkey") + 20.0).alias("latitude"), (F.col("n_nationkey") * 0.5 - 5.0).alias("longitude")
    )
    return snapped(analytics.map_with_missing_regions(points, nations))


@query
def price_trend(spark, sf_dir):
    return snapped(analytics.price_trend(tables.prices(spark, sf_dir)))


@query
def event_trend(spark, sf_dir):
    """The same report on the events table: mean value per day and type."""
    rows = tables.read(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("event_type").alias("product"), F.col("value").alias("price")
    )
    return snapped(analytics.price_trend(rows))


@query
def ramadan_months(spark, sf_dir):
    return analytics.ramadan_months(add_temporal_features(_shifted(spark, sf_dir, 300)))


@query
def heatmap_month_region(spark, sf_dir):
    return snapped(analytics.heatmap_month_region(tables.prices(spark, sf_dir), "Brand#7"))


@query
def compare_regions_latest(spark, sf_dir):
    return snapped(analytics.compare_regions_latest(_known(spark, sf_dir)))


@query
def price_boxplot(spark, sf_dir):
    return snapped(analytics.price_boxplot(tables.prices(spark, sf_dir)))


@query
def descriptive_stats(spark, sf_dir):
    return snapped(analytics.descriptive_stats(tables.prices(spark, sf_dir)), 1)


@query
def alert_board(spark, sf_dir):
    return analytics.alert_board(tables.scored_panel(spark, sf_dir), 100, anomaly.SEVERITIES_FR)


@query
def forecast_table(spark, sf_dir):
    return analytics.forecast_table(forecast.forecast_quadratic(_known(spark, sf_dir), 6))


@query
def median_by_product(spark, sf_dir):
    return snapped(analytics.median_by_product(tables.prices(spark, sf_dir)))


@query
def rows_by_region(spark, sf_dir):
    return analytics.rows_by_region(tables.observations(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return analytics.null_profile(tables.gap_rows(spark, sf_dir)).withColumns(
        {c: F.to_date(c) for c in ("min_date", "max_date")}
    )


@query
def top_products(spark, sf_dir):
    return snapped(analytics.top_products(tables.prices(spark, sf_dir)))


@query
def monthly_seasonality(spark, sf_dir):
    return snapped(analytics.monthly_seasonality(tables.prices(spark, sf_dir)))


@query
def ramadan_effect(spark, sf_dir):
    rows = tables.prices(spark, sf_dir).withColumn("date", F.add_months(F.to_date("date"), 300))
    return snapped(analytics.ramadan_effect(rows))


@query
def yoy_inflation(spark, sf_dir):
    """One year of some products has no prices."""
    blank = (F.year("date") == 1998) & (F.length("product") == 7)
    rows = tables.prices(spark, sf_dir).withColumn("price", F.when(~blank, F.col("price")))
    return snapped(analytics.yoy_inflation(rows))


@query
def pivot_latest(spark, sf_dir):
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    return snapped(analytics.pivot_latest(_known(spark, sf_dir), regions))


@query
def product_correlation(spark, sf_dir):
    return snapped(analytics.product_correlation(_known(spark, sf_dir)))


@query
def product_correlation_blocks(spark, sf_dir):
    """The same figures by blocks of eight products and chunks of sixteen months."""
    return snapped(gram.product_correlation(_known(spark, sf_dir), 8, 16))


@query
def series_with_anomalies(spark, sf_dir):
    return snapped(analytics.series_with_anomalies(tables.scored_panel(spark, sf_dir), "Brand#7", "ASIA"))


@query
def top_alerts(spark, sf_dir):
    alerts = anomaly.generate_alerts(tables.scored_panel(spark, sf_dir)).drop("message")
    return snapped(analytics.top_alerts(alerts, 10))


@query
def price_labels(spark, sf_dir):
    rows = tables.changes(spark, sf_dir)
    return rows.select(
        "product", "region", "date",
        format_price(F.col("price")).alias("price_label"),
        signed_percent(F.col("pct_change_1m")).alias("change_label"),
    )


@query
def history_with_forecast(spark, sf_dir):
    known = _known(spark, sf_dir)
    return snapped(forecast.history_with_forecast(known, forecast.forecast_quadratic(known, 6)))


@query
def forecast_reply(spark, sf_dir):
    return snapped(forecast.forecast_reply(_known(spark, sf_dir), "Brand#7", "ASIA", 6))
