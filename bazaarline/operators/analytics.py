"""Reports over a price panel, a scored panel, alerts or forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import is_ramadan
from ..functions.quantiles import group_quantiles
from ..functions.scalars import ratio, signed_percent
from ..functions.staging import stage
from .anomaly import severity


def latest_date(df: DataFrame) -> Column:
    """The newest date as a scalar subquery; one row, whatever the table's size."""
    return df.agg(F.max("date")).scalar()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def filter_panel(
    df: DataFrame,
    products: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """The given filters on raw columns, so that they reach the scan."""
    for column, wanted in (("product", products), ("region", regions), ("category", categories)):
        if wanted:
            df = df.where(F.col(column).isin(list(wanted)))
    if start:
        df = df.where(F.col("date") >= F.lit(start))
    if end:
        df = df.where(F.col("date") <= F.lit(end))
    return df


def query_prices(
    df: DataFrame,
    product: str | None = None,
    region: str | None = None,
    start: date | None = None,
    end: date | None = None,
    limit: int = 100,
) -> DataFrame:
    """Newest rows first; LookupError when nothing has the product, or then the region."""
    if limit > 5000:
        raise ValueError("limit must be at most 5000")
    for column, wanted in (("product", product), ("region", region)):
        if wanted:
            df = df.where(F.col(column) == wanted)
            if df.select(column).isEmpty():
                raise LookupError(f"{column.title()} '{wanted}' not found.")
    rows = filter_panel(df, start=start, end=end).select("date", "product", "region", "price")
    top = rows.orderBy(F.desc("date"), "product", "region", "price").limit(limit)
    return top.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def query_alerts(
    alerts: DataFrame,
    severity: str | None = None,
    product: str | None = None,
    region: str | None = None,
    limit: int = 50,
) -> DataFrame:
    if limit > 500:
        raise ValueError("limit must be at most 500")
    if severity:
        alerts = alerts.where(F.col("severity") == severity.upper())
    rows = filter_panel(alerts, [product] if product else None, [region] if region else None)
    return top_alerts(rows, limit)


def top_alerts(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.orderBy(F.desc("anomaly_score"), "product", "region", "date").limit(n)


def kpi_summary(scored: DataFrame) -> DataFrame:
    """Mean price now and a month before, change, and counts, on one row.

    The dates are reduced to sums first, so the newest date is looked up among
    dates and not among rows.
    """
    by_date = scored.groupBy("date").agg(F.sum("price").alias("total"), F.count("price").alias("n"))
    mean_at = lambda d: ratio(
        F.sum(F.when(F.col("date") == d, F.col("total"))), F.sum(F.when(F.col("date") == d, F.col("n")))
    )
    latest = latest_date(scored)
    prices = by_date.withColumn("_last", latest).agg(
        mean_at(F.col("_last")).alias("avg_now"), mean_at(F.add_months("_last", -1)).alias("_prev")
    )
    now, before = F.col("avg_now"), F.coalesce("_prev", "avg_now")
    counts = scored.agg(
        F.countDistinct("product").alias("n_products"),
        F.countDistinct("region").alias("n_regions"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_anomaly").alias("n_anomalies"),
        F.count_if(F.col("anomaly_score") >= 0.95).alias("n_critical"),
    )
    return prices.select(
        now.alias("avg_now"),
        before.alias("avg_prev"),
        F.coalesce(ratio(now - before, before) * 100, F.lit(0.0)).alias("mom_pct"),
        *[counts.select(c).scalar().alias(c) for c in counts.columns],
    )


def map_latest(df: DataFrame, product: str) -> DataFrame:
    """Mean price per region at the product's newest date, with its first coordinates."""
    one = df.where(F.col("product") == product)
    order = F.struct("latitude", "longitude")
    return (
        one.where(F.col("date") == latest_date(one))
        .groupBy("region")
        .agg(F.avg("price").alias("price"), F.min(order).alias("_at"))
        .select("region", "price", "_at.latitude", "_at.longitude")
    )


def map_with_missing_regions(points: DataFrame, regions: DataFrame) -> DataFrame:
    """All regions: priced ones with a marker size by price, the others marked as such.

    ``regions`` has region, latitude and longitude.
    """
    absent = regions.join(points.select("region"), "region", "left_anti").select(
        "region", F.lit(None).cast("double").alias("price"), "latitude", "longitude"
    )
    rows = points.unionByName(absent).dropna(subset=["latitude", "longitude"])
    low, high = points.agg(F.min("price")).scalar(), points.agg(F.max("price")).scalar()
    size = 12 + 28 * (F.col("price") - low) / F.greatest(high - low, F.lit(1.0))
    has_price = F.col("price").isNotNull()
    return rows.select("*", has_price.alias("has_price"), F.when(has_price, size).otherwise(8.0).alias("marker_size"))


def price_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("date", "product").agg(F.avg("price").alias("price"))


def ramadan_months(df: DataFrame, limit: int = 10) -> DataFrame:
    """The first flagged dates, each with the date one month later."""
    starts = df.where("is_ramadan = 1").select(F.col("date").alias("period_start")).distinct()
    return (
        starts.orderBy("period_start").limit(limit)
        .withColumn("period_end", F.add_months("period_start", 1))
    )


def heatmap_month_region(df: DataFrame, product: str) -> DataFrame:
    label = F.date_format("date", "yyyy-MM").alias("label")
    return df.where(F.col("product") == product).groupBy(label, "region").agg(F.avg("price").alias("price"))


def compare_regions_latest(df: DataFrame) -> DataFrame:
    latest = df.where(F.col("date") == latest_date(df))
    return latest.groupBy("region", "product").agg(F.avg("price").alias("price"))


def price_boxplot(df: DataFrame) -> DataFrame:
    """Five-number summary per product, highest median first."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return group_quantiles(df, ["product"], "price", probs).orderBy(F.desc("median"), "product")


def descriptive_stats(df: DataFrame) -> DataFrame:
    """Mean, median, deviation, least and greatest price per product."""
    df = stage(df.select("product", "price"), "prices")
    figures = df.groupBy("product").agg(
        F.avg("price").alias("mean"),
        F.stddev_samp("price").alias("std"),
        F.min("price").alias("min"),
        F.max("price").alias("max"),
    )
    medians = group_quantiles(df, ["product"], "price", {"median": 0.5}, staged=True)
    return figures.join(medians, "product").select(
        "product", "mean", "median", "std", "min", "max"
    )


def median_by_product(df: DataFrame) -> DataFrame:
    return group_quantiles(df, ["product"], "price", {"median_price": 0.5}).orderBy("median_price", "product")


def top_products(df: DataFrame, n: int = 4, staged: bool = False) -> DataFrame:
    medians = group_quantiles(df, ["product"], "price", {"median_price": 0.5}, staged)
    return medians.orderBy(F.desc("median_price"), "product").limit(n)


def monthly_seasonality(df: DataFrame, n: int = 4) -> DataFrame:
    """Mean price by calendar month of the n products with the highest median."""
    df = stage(df.select("product", F.month("date").alias("month"), "price"), "prices")
    chosen = df.join(top_products(df, n, staged=True), "product", "left_semi")
    return chosen.groupBy("product", "month").agg(F.avg("price").alias("price"))


def rows_by_region(df: DataFrame) -> DataFrame:
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows")).orderBy("region")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column and the range of dates and years, on one row."""
    missing = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in df.columns]
    return df.agg(
        *missing,
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.min(F.year("date")).alias("min_year"),
        F.max(F.year("date")).alias("max_year"),
    )


def ramadan_effect(df: DataFrame, flag: Column | None = None) -> DataFrame:
    """Mean price inside and outside Ramadan per product and the effect in percent."""
    flag = is_ramadan(F.col("date")) if flag is None else flag
    inside = F.avg(F.when(flag == 1, F.col("price")))
    outside = F.avg(F.when(flag == 0, F.col("price")))
    return (
        df.groupBy("product")
        .agg(outside.alias("outside"), inside.alias("inside"))
        .withColumn("effect_pct", (ratio(F.col("inside"), F.col("outside")) - 1) * 100)
        .orderBy(F.desc("effect_pct"), "product")
    )


def yoy_inflation(df: DataFrame) -> DataFrame:
    """Change of the yearly mean price; a year without prices reads as the year before.

    The grid has every product in every year that any product has.
    """
    yearly = df.groupBy("product", F.year("date").alias("year")).agg(F.avg("price").alias("price"))
    years = yearly.agg(F.sort_array(F.collect_set("year"))).scalar()
    grid = yearly.select("product").distinct().select("product", F.explode(years).alias("year"))
    series = W.partitionBy("product").orderBy("year")
    held = F.last("price", ignorenulls=True).over(series.rowsBetween(W.unboundedPreceding, 0))
    full = grid.join(yearly, ["product", "year"], "left").withColumn("_held", held)
    change = (ratio(F.col("_held"), F.lag("_held").over(series)) - 1) * 100
    return full.select("product", "year", "price", change.alias("yoy_pct"))


def pivot_latest(df: DataFrame, regions: Sequence[str]) -> DataFrame:
    """Mean price at the newest date, a row per product and a column per region."""
    latest = df.where(F.col("date") == latest_date(df))
    return latest.groupBy("product").pivot("region", list(regions)).agg(F.avg("price")).fillna(0.0)


def product_correlation(df: DataFrame) -> DataFrame:
    """Pearson correlation of the products' mean price over their common dates.

    The report has a row per pair of products. Prices are first reduced to one
    mean per (product, date), so the pairs are of products within a date only.
    """
    means = df.groupBy("date", "product").agg(F.avg("price").alias("price"))
    a = means.select("date", F.col("product").alias("product_a"), F.col("price").alias("_a"))
    b = means.select("date", F.col("product").alias("product_b"), F.col("price").alias("_b"))
    pairs = a.join(b, "date").where(F.col("product_a") > F.col("product_b"))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    # corr() divides by zero where a price doesn't vary
    spread = F.stddev_pop(F.when(both, F.col("_a"))) * F.stddev_pop(F.when(both, F.col("_b")))
    return pairs.groupBy("product_a", "product_b").agg(
        ratio(F.covar_pop("_a", "_b"), spread).alias("correlation"), F.count_if(both).alias("n_dates")
    )


def series_with_anomalies(scored: DataFrame, product: str, region: str) -> DataFrame:
    one = scored.where((F.col("product") == product) & (F.col("region") == region))
    return one.select(
        "date", "price", "is_anomaly", F.when(F.col("is_anomaly"), F.col("price")).alias("anomaly_price")
    ).orderBy("date")


def alert_board(scored: DataFrame, n: int = 100, labels: Sequence[str] | None = None) -> DataFrame:
    """Highest-scored flagged rows with their figures as text."""
    grade = severity(F.col("anomaly_score"), labels) if labels else severity(F.col("anomaly_score"))
    return top_alerts(scored.where("is_anomaly"), n).select(
        F.date_format("date", "yyyy-MM").alias("month"),
        "product",
        "region",
        F.format_number(F.round("price", 0), 0).alias("price"),
        F.coalesce(signed_percent(F.col("pct_change_1m")), F.lit("—")).alias("mom"),
        F.format_string("%.2f", F.round("anomaly_score", 2)).alias("score"),
        grade.alias("severity"),
    )


def forecast_table(forecast: DataFrame) -> DataFrame:
    number = lambda c: F.format_number(F.round(c, 0), 0)
    return forecast.select(
        "product",
        "region",
        F.date_format("ds", "yyyy-MM").alias("month"),
        *[number(c).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
    )
