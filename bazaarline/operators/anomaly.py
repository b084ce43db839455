"""Anomaly scores per series and the alerts made from them.

A fitted detector is a table with one row per (product, region): scaler arrays,
isolation forest, boundary rows. It is fitted by aggregation over all series at
once, saved and loaded as Parquet, and joined to the rows it scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.scalars import ratio, snap
from ..functions.staging import spread, stage
from ..settings import Settings
from ..sources.validate import require_columns
from .boundary import add_similarity, fit_boundary, similarity
from .features import GROUP, last_rows, over_time
from .isolation import add_isolation_score, fit_forest, isolation

FEATURES = ["price", "diff", "diff_pct", "roll_mean", "roll_std", "z_score"]
SCALED = [f"s_{f}" for f in FEATURES]
MIN_ROWS = 10

# Lower ends of the severity grades and their labels.
GRADES = (0.95, 0.85, 0.75)
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
SEVERITIES_FR = ("🔴 CRITIQUE", "🟠 ÉLEVÉE", "🟡 MOYENNE", "🟢 FAIBLE")


def detection_features(
    df: DataFrame,
    window: int = 6,
    keys: Sequence[str] = GROUP,
    order: Sequence[str] = ("date",),
) -> DataFrame:
    """Level, first difference, change in percent, rolling mean, deviation and z-score."""
    back = F.lag("price").over(over_time(keys, order))
    rows = last_rows(window, keys, order)
    diff = F.coalesce(F.col("price") - F.col("_back"), F.lit(0.0))
    z = ratio(F.col("price") - F.col("roll_mean"), F.col("roll_std"))
    return (
        df.withColumns(
            {
                "_back": back,
                "roll_mean": F.avg("price").over(rows),
                "roll_std": F.coalesce(F.stddev_samp("price").over(rows), F.lit(0.0)),
            }
        )
        .withColumns(
            {
                "diff": diff,
                "diff_pct": F.coalesce(ratio(diff, F.col("_back")) * 100, F.lit(0.0)),
                "z_score": F.when(F.col("roll_std") > 0, z).otherwise(0.0),
            }
        )
        .drop("_back")
    )


def scale_parameters(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """One row per series: arrays ``means`` and ``deviations`` (1 for a constant)."""
    deviation = lambda f: F.when(F.stddev_pop(f) == 0, 1.0).otherwise(F.stddev_pop(f))
    return df.groupBy(*GROUP).agg(
        F.array(*[F.avg(f) for f in features]).alias("means"),
        F.array(*[deviation(f) for f in features]).alias("deviations"),
        F.count(F.lit(1)).alias("fit_rows"),
    )


def apply_scale(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``s_<feature>`` from the ``means`` and ``deviations`` columns."""
    return df.withColumns(
        {
            f"s_{f}": (F.col(f) - F.get("means", F.lit(i))) / F.get("deviations", F.lit(i))
            for i, f in enumerate(features)
        }
    )


def scale_features(df: DataFrame, parameters: DataFrame) -> DataFrame:
    return apply_scale(df.join(parameters, GROUP)).drop("means", "deviations", "fit_rows")


def scaled_training_rows(df: DataFrame, window: int = 6) -> DataFrame:
    """Scaled features of the series long enough to fit."""
    featured = detection_features(df, window)
    parameters = scale_parameters(featured).where(F.col("fit_rows") >= MIN_ROWS)
    return scale_features(featured, parameters)


def day_label() -> Column:
    return F.date_format("date", "yyyy-MM-dd")


def fit_detector(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The detector table of every series with at least ``MIN_ROWS`` rows."""
    require_columns(df, ["date", "product", "region", "price"])
    series = W.partitionBy(*GROUP)
    spreads = [F.stddev_pop(f).over(series) for f in FEATURES]
    scaled = (
        detection_features(spread(df, *GROUP), settings.window)
        .withColumns(
            {
                "means": F.array(*[F.avg(f).over(series) for f in FEATURES]),
                "deviations": F.array(*[F.when(d == 0, 1.0).otherwise(d) for d in spreads]),
                "fit_rows": F.count(F.lit(1)).over(series),
            }
        )
        .where(F.col("fit_rows") >= MIN_ROWS)
    )
    kept = ["means", "deviations", "fit_rows"]
    scaled = stage(apply_scale(scaled).select(*GROUP, "date", *SCALED, *kept), "scaled")
    parameters = scaled.groupBy(*GROUP).agg(*[F.any_value(c).alias(c) for c in kept])
    forest = fit_forest(
        scaled, GROUP, SCALED, day_label(), settings.trees, settings.seed, sizes="fit_rows"
    )
    boundary = fit_boundary(scaled, GROUP, SCALED, nu=settings.nu)
    return stage(parameters.join(forest, GROUP).join(boundary, GROUP), "detector")


def save_detector(detector: DataFrame, path: str, threshold: float = 0.7) -> None:
    """One Parquet table with the alert threshold in a column."""
    detector.withColumn("threshold", F.lit(threshold)).write.mode("overwrite").parquet(path)


def load_detector(spark, path: str) -> DataFrame:
    """The saved table; its ``threshold`` column is used when scoring."""
    return spark.read.parquet(path)


def normalise_score(raw: Column, keys: Sequence[str] = GROUP) -> Column:
    """Flips a score whose low values are odd, then min-max by group; constant gives 0."""
    group = W.partitionBy(*keys)
    low, high = F.min(raw).over(group), F.max(raw).over(group)
    return F.when(high == low, 0.0).otherwise((high - raw) / (high - low))


def composite_score(df: DataFrame, threshold: Column | float = 0.7) -> DataFrame:
    """Even mix of both scores and the flag; the threshold applies to six digits."""
    score = 0.5 * F.col("if_score") + 0.5 * F.col("svm_score")
    threshold = F.lit(threshold) if isinstance(threshold, float) else threshold
    return df.withColumn("anomaly_score", score).withColumn(
        "is_anomaly", snap(F.col("anomaly_score"), 6) >= threshold
    )


def raw_scores(df: DataFrame, detector: DataFrame, on: Sequence[str] = GROUP) -> DataFrame:
    """``_if`` and ``_svm``: isolation score and boundary similarity of featured rows.

    Series without a detector keep their rows, with missing raw scores.
    """
    on = list(on)
    scales = detector.select(*on, "means", "deviations")
    scaled = apply_scale(df.join(scales, on, "left")).select(*df.columns, *SCALED)
    isolated = add_isolation_score(scaled, detector, on, SCALED, "_if")
    return add_similarity(isolated, detector, on, SCALED, "_svm")


def predict(
    df: DataFrame,
    detector: DataFrame,
    settings: Settings = Settings(),
    keys: Sequence[str] = GROUP,
    order: Sequence[str] = ("date",),
    on: Sequence[str] = GROUP,
) -> DataFrame:
    """``if_score``, ``svm_score``, ``anomaly_score`` and ``is_anomaly`` of every row.

    ``keys`` and ``order`` describe a series, ``on`` the part of the keys that
    finds its detector. One shuffle by ``on`` serves all windows and joins.
    """
    featured = detection_features(spread(df, *on), settings.window, keys, order)
    raw = with_fixed_digits(raw_scores(featured, detector, on))
    scores = raw.withColumns(
        {
            "if_score": F.coalesce(normalise_score(F.col("_odd_if"), keys), F.lit(0.0)),
            "svm_score": F.coalesce(normalise_score(F.col("_odd_svm"), keys), F.lit(0.0)),
        }
    )
    return composite_score(scores, threshold_of(detector, settings)).select(
        *df.columns, "if_score", "svm_score", "anomaly_score", "is_anomaly"
    )


def with_fixed_digits(raw: DataFrame) -> DataFrame:
    """Raw scores of which low values are odd; fixed digits, so that rounding noise
    cannot stand in for a spread."""
    return raw.withColumns({"_odd_if": snap(-F.col("_if"), 9), "_odd_svm": snap(F.col("_svm"), 9)})


def threshold_of(detector: DataFrame, settings: Settings) -> Column:
    """The threshold saved with the detector, else that of the settings."""
    if "threshold" in detector.columns:
        return detector.agg(F.max("threshold")).scalar()
    return F.lit(settings.alert_threshold)


def score_panel(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Fit on the table and score it; series under ten rows score 0."""
    return predict(df, fit_detector(df, settings), settings)


def severity(score: Column, labels: Sequence[str] = SEVERITIES) -> Column:
    return (
        F.when(score >= GRADES[0], labels[0])
        .when(score >= GRADES[1], labels[1])
        .when(score >= GRADES[2], labels[2])
        .otherwise(labels[3])
    )


def alert_message() -> Column:
    change = F.coalesce(F.col("pct_change_1m"), F.lit(0.0))
    return F.format_string(
        "%s price in %s on %s: %.0f DZD (%s%.1f%% MoM). Anomaly score: %.2f.",
        F.col("product"),
        F.col("region"),
        F.date_format("date", "yyyy-MM"),
        F.round("price", 0),
        F.when(change >= 0, "▲").otherwise("▼"),
        F.round(F.abs(change), 1),
        F.round("anomaly_score", 2),
    )


def generate_alerts(scored: DataFrame) -> DataFrame:
    """One alert record per flagged row."""
    if "pct_change_1m" not in scored.columns:
        scored = scored.withColumn("pct_change_1m", F.lit(0.0))
    return scored.where("is_anomaly").select(
        "date",
        *GROUP,
        "price",
        F.round("anomaly_score", 4).alias("anomaly_score"),
        F.lit("ensemble").alias("algorithm"),
        severity(F.col("anomaly_score")).alias("severity"),
        alert_message().alias("message"),
    )


def history_context(scored: DataFrame, reach: int) -> DataFrame:
    """What a new row needs to know about its place in a series, one row per place and month.

    A place is after a history row, or before the first one. It has the ``reach``
    prices on either side, the range of dates that fall on it (``since`` <= date <
    ``until``) and the least and greatest raw scores of the rows further away, whose
    scores a new row cannot change. A place is repeated for every month of its range,
    which the calendar bounds, so that observations find it by an equi-join.
    """
    along = W.partitionBy(*GROUP).orderBy("date")
    near = lambda first, last: F.collect_list("price").over(along.rowsBetween(first, last))
    up_to, from_ = W.unboundedPreceding, W.unboundedFollowing

    def ends(first: int | None, last: int) -> Column:
        """Least and greatest raw scores outside of the affected rows."""
        out = []
        for name in ("_odd_if", "_odd_svm"):
            for pick, both in ((F.min, F.least), (F.max, F.greatest)):
                late = pick(name).over(along.rowsBetween(last, from_))
                early = late if first is None else pick(name).over(along.rowsBetween(up_to, first))
                out.append(both(early, late).alias(f"{pick.__name__}{name}"))
        return F.struct(*out)

    month = F.year("date") * 12 + F.month("date")
    after = F.struct(
        F.col("date").alias("since"), F.lead("date").over(along).alias("until"),
        near(1 - reach, 0).alias("before"), near(1, reach).alias("after"), ends(0, reach + 1).alias("rest"),
    )
    first = F.struct(
        F.lit(None).cast(scored.schema["date"].dataType).alias("since"), F.col("date").alias("until"),
        F.slice(near(0, 0), 1, 0).alias("before"), near(0, reach - 1).alias("after"), ends(None, reach).alias("rest"),
    )
    rows = scored.select(
        *GROUP, month.alias("_month"), F.lead(month).over(along).alias("_next"),
        F.row_number().over(along).alias("_row"), after.alias("_after"), first.alias("_first"),
    )
    own = F.transform(
        F.sequence("_month", F.coalesce("_next", "_month")), lambda m: F.struct(m.alias("month"), F.col("_after").alias("place"))
    )
    head = F.array(F.struct(F.col("_month").alias("month"), F.col("_first").alias("place")))
    places = F.when(F.col("_row") == 1, F.concat(head, own)).otherwise(own)
    return rows.select(*GROUP, F.explode(places).alias("_p")).select(*GROUP, "_p.month", "_p.place.*")


def local_features(prices: Column, at: Column, window: int) -> Column:
    """``FEATURES`` of one row of a price array, as ``detection_features`` has them."""
    price, back = F.get(prices, at), F.get(prices, at - 1)
    begin = F.greatest(at - window + 1, F.lit(0))
    rows = F.slice(prices, begin + 1, at - begin + 1)
    count, base = F.size(rows), F.get(rows, F.lit(0))
    total = lambda array, value: F.aggregate(array, F.lit(0.0), lambda sum_, p: sum_ + value(p))
    mean = base + total(rows, lambda p: p - base) / count
    spread_ = total(rows, lambda p: (p - mean) * (p - mean))
    deviation = F.when(count > 1, F.sqrt(spread_ / (count - 1))).otherwise(0.0)
    diff = F.coalesce(price - back, F.lit(0.0))
    return F.array(
        price,
        diff,
        F.coalesce(ratio(diff, back) * 100, F.lit(0.0)),
        mean,
        deviation,
        F.when(deviation > 0, (price - mean) / deviation).otherwise(0.0),
    )


def score_new_observations(
    history: DataFrame,
    new: DataFrame,
    detector: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """Score each new price (``obs_id``, product, region, date, price) in its series.

    Observations do not affect each other, and each gives one row, also where ids
    repeat. The history is scored once. An observation changes only its own raw score
    and those of the next ``window`` - 1 rows, so it is joined to its place in the
    series, those rows alone are scored again, and the least and greatest of the others
    come with the place. ``found`` is false, and the figures missing, without a history.
    """
    reach = max(settings.window - 1, 1)
    featured = detection_features(spread(history.select(*GROUP, "date", "price"), *GROUP), settings.window)
    scored = stage(with_fixed_digits(raw_scores(featured, detector)), "history")
    month = F.year("date") * 12 + F.month("date")
    calendars = stage(
        scored.groupBy(*GROUP).agg(F.min(month).alias("_from"), F.max(month).alias("_to")), "calendars"
    )
    places = stage(history_context(scored, reach), "places")
    fitted = detector.select(
        *GROUP, "means", "deviations", F.col("forest").alias("_forest"), F.col("psi").alias("_psi"), F.col("boundary").alias("_points")
    )
    clipped = F.least(F.greatest(month, F.col("_from")), F.col("_to"))
    dated = new.select("obs_id", *GROUP, "price", "date").join(calendars, GROUP, "left").withColumn("month", clipped)
    # An open range goes to the first or the last month, where clipping sends what is outside.
    own, at = dated.alias("o"), places.alias("p")
    same = [F.col(f"o.{k}") == F.col(f"p.{k}") for k in [*GROUP, "month"]]
    since, until = F.col("p.since"), F.col("p.until")
    day = F.col("o.date").cast(scored.schema["date"].dataType)
    inside = (since.isNull() | (since <= day)) & (until.isNull() | (day < until))
    placed = own.join(at, [*same, inside], "left").select("o.*", "p.before", "p.after", "p.rest").join(fitted, GROUP, "left")

    prices = F.concat("before", F.array("price"), "after")
    affected = F.sequence(F.size("before"), F.size("before") + F.size("after"))
    scale = lambda f, i: (f - F.get("means", i)) / F.get("deviations", i)
    rows = placed.withColumn("_prices", prices).withColumn(
        "_x", F.transform(affected, lambda i: F.transform(local_features(F.col("_prices"), i, settings.window), scale))
    )
    raw = rows.withColumns(
        {
            "_odd_if": F.transform("_x", lambda x: snap(-isolation(x, F.col("_forest"), F.col("_psi")), 9)),
            "_odd_svm": F.transform("_x", lambda x: snap(similarity(x, F.col("_points"), len(FEATURES)), 9)),
        }
    )

    def normalised(name: str) -> Column:
        low = F.least(F.array_min(name), F.col(f"rest.min{name}"))
        high = F.greatest(F.array_max(name), F.col(f"rest.max{name}"))
        score = F.when(high == low, 0.0).otherwise((high - F.get(name, F.lit(0))) / (high - low))
        return F.when(F.col("before").isNotNull(), F.coalesce(score, F.lit(0.0)))

    scores = raw.withColumns({"if_score": normalised("_odd_if"), "svm_score": normalised("_odd_svm")})
    graded = composite_score(scores, threshold_of(detector, settings))
    found = F.col("anomaly_score").isNotNull()
    return graded.select(
        "obs_id",
        *GROUP,
        "price",
        "date",
        F.round("anomaly_score", 4).alias("anomaly_score"),
        "is_anomaly",
        F.when(found, severity(F.col("anomaly_score"))).alias("severity"),
        found.alias("found"),
    )


def isolation_score_simple(
    df: DataFrame, trees: int = 60, seed: int = 42, min_rows: int = 12, threshold: float = 0.75
) -> DataFrame:
    """The board's scores: trees on price, change and rolling mean, min-max scaled.

    Expects ``pct_change_1m`` and ``rolling_3m``; shorter series score 0.
    """
    names = ["price", "pct_change_1m", "rolling_3m"]
    series = W.partitionBy(*GROUP)
    filled = spread(df, *GROUP).withColumns({f"_{n}": F.coalesce(F.col(n), F.lit(0.0)) for n in names})
    scale = lambda n: F.coalesce(
        ratio(F.col(n) - F.min(n).over(series), F.max(n).over(series) - F.min(n).over(series)), F.lit(0.0)
    )
    scaled = stage(filled.withColumns({f"m_{n}": scale(f"_{n}") for n in names}), "scaled")
    features = [f"m_{n}" for n in names]
    enough = scaled.groupBy(*GROUP).count().where(F.col("count") >= min_rows).select(*GROUP)
    fitted = scaled.join(enough, GROUP, "left_semi").select(*GROUP, "date", *features)
    forest = stage(fit_forest(fitted, GROUP, features, day_label(), trees, seed), "forest")
    raw = add_isolation_score(scaled, forest, GROUP, features, "_s")
    raw = raw.withColumn("_d", snap(-F.col("_s"), 9))
    low, high = F.min("_d").over(series), F.max("_d").over(series)
    odd = 1 - (F.col("_d") - low) / (high - low + 1e-9)
    scored = raw.withColumn("_odd", F.coalesce(odd, F.lit(0.0)))
    return scored.select(
        *df.columns,
        snap(F.col("_odd")).alias("anomaly_score"),
        (snap(F.col("_odd"), 6) >= threshold).alias("is_anomaly"),
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    flagged = F.count_if("is_anomaly")
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        flagged.alias("n_anomalies"),
        F.avg(F.col("is_anomaly").cast("int")).alias("anomaly_rate"),
        flagged.alias("n_alerts"),
    )


def anomalies_by_product(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("product")
        .agg(F.count_if("is_anomaly").alias("n_anomalies"))
        .orderBy(F.desc("n_anomalies"), "product")
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("n_alerts")).orderBy(F.desc("n_alerts"), "severity")


def alert_bands(scored: DataFrame) -> DataFrame:
    """Flagged rows in all and by grade, on one row."""
    score = F.col("anomaly_score")
    return scored.where("is_anomaly").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(score >= GRADES[0]).alias("critical"),
        F.count_if((score >= GRADES[1]) & (score < GRADES[0])).alias("high"),
        F.count_if((score >= GRADES[2]) & (score < GRADES[1])).alias("medium"),
    )


def score_histogram(scored: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per equal-width class of the score; a score of 1 falls in the last."""
    place = F.least(F.floor(F.col("anomaly_score") * bins + 1e-9) + 1, F.lit(bins))
    return scored.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("bin")
