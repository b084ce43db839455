"""Cleaning of raw price rows.

The rows of one (product, region) may be a large share of the table, so no step
gathers a group: statistics are partial aggregates joined back to the rows,
quantiles are exact but bracketed, and interpolation works on date chunks.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F

from ..functions.quantiles import attach, group_quantiles
from ..functions.scalars import known, present
from ..functions.staging import spread, stage
from ..settings import Settings
from ..sources.validate import require_columns, validate_table
from .isolation import SAMPLE, add_isolation_score, fit_forest

GROUP = ["product", "region"]
FINE_GROUP = ["product", "region", "market"]
SLOTS = 64  # pieces of one midnight, and of the rest of that day, in interpolation
SPAN = 64  # days that a chunk of interpolation may cover
FULL = 4096  # rows over which a span is cut into days, and a day into slots


def standardise_types(
    df: DataFrame, as_of: Column | None = None, keep_missing: bool = False
) -> DataFrame:
    """Typed date and prices; drops future dates and prices that are not above 0.

    ``keep_missing`` keeps rows without a price, for imputation afterwards.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    kind = dict(df.dtypes)["date"]
    day = F.try_to_timestamp("date") if kind == "string" else F.col("date")
    columns = {"date": day}
    for name in present(df, ["price", "price_usd"]):
        text = F.trim(name) if dict(df.dtypes)[name] == "string" else F.col(name)
        number = text.try_cast("double")
        columns[name] = F.nanvl(number, F.lit(None).cast("double"))
    typed = df.withColumns(columns)
    priced = F.col("price") > 0
    if keep_missing:
        priced = priced | F.col("price").isNull()
    return typed.where((F.col("date") <= as_of) & priced)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; copies are merged before the shuffle."""
    return df.dropDuplicates()


def impute_drop(df: DataFrame) -> DataFrame:
    return df.where(known(df, "price").isNotNull())


def impute_mean(df: DataFrame) -> DataFrame:
    keys = present(df, FINE_GROUP)
    means = df.groupBy(*keys).agg(F.avg(known(df, "price")).alias("_fill"))
    return _fill(df, means, keys)


def impute_median(df: DataFrame) -> DataFrame:
    keys = present(df, FINE_GROUP)
    return _fill(df, group_quantiles(df, keys, "price", {"_fill": 0.5}), keys)


def _fill(df: DataFrame, figures: DataFrame, keys: Sequence[str]) -> DataFrame:
    filled = attach(df, stage(figures, "fill"), keys)
    price = F.coalesce(known(df, "price"), F.col("_fill"))
    return filled.withColumn("price", price).drop("_fill").where("price is not null")


def impute_interpolate(df: DataFrame, tie: Column | None = None) -> DataFrame:
    """Linear by row position, then the last known price forward, then the first back.

    Rows are ordered by date within (product, region, market); rows of one date
    are ordered by ``tie``, a whole number (first its remainder by ``SLOTS``), by
    default a hash of their other columns. A chunk is a span of ``SPAN`` days; in a
    span of over ``FULL`` rows it is a day, and in a day of over ``FULL`` rows one
    slot of it: a share of the hashes at midnight, a stretch of time after it.
    Positions and known prices at chunk borders come from a table with a row per
    chunk, which the calendar bounds, so a group's rows are never brought together.
    Copies of one row share a hash: drop exact duplicates first.
    """
    keys = present(df, FINE_GROUP)
    rest = [c for c in df.columns if c not in (*keys, "date", "price")]
    source = df.withColumn("price", known(df, "price")).dropna(subset=keys or None)
    if tie is None:
        tie = F.xxhash64(*rest, "price") if rest else F.xxhash64("price")
    day = F.to_date("date")
    span = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / SPAN)
    full = stage(full_spans(source.select(*keys, day.alias("_day"), span.alias("_span")), keys), "full-spans")
    chunk = [*keys, "_from", "_slot"]
    second = F.hour("date") * 3600 + F.minute("date") * 60 + F.second("date")
    timed = SLOTS + F.floor(second * SLOTS / 86400)
    midnight = F.col("date") == F.col("_day")
    cut = F.array_contains("_cut_days", F.col("_day"))
    placed = (
        source.withColumns({"_tie": tie, "_day": day, "_span": span})
        .join(full, [*keys, "_span"], "left")
        .withColumn("_place", F.when(midnight, F.pmod("_tie", F.lit(SLOTS))).otherwise(timed))
        .withColumn("_from", F.when(F.col("_cut_days").isNotNull(), F.datediff("_day", F.lit("1970-01-01").cast("date"))).otherwise(F.col("_span") * SPAN))
        .withColumn("_slot", F.when(cut, F.col("_place")).otherwise(-1))
        .select(*df.columns, *chunk[len(keys) :], "_day", "_place", "_tie")
    )
    order = ["_day", "_place", "date", "_tie", *rest, "price"]
    inside = W.partitionBy(*chunk).orderBy(*order)
    # position and price of the nearest known row before and after, for rows without a price
    gap = F.col("price").isNull()
    quoted = lambda names: ", ".join(f"`{n.replace('`', '``')}`" for n in names)
    ahead = f"lead(_known) ignore nulls over (partition by {quoted(chunk)} order by {quoted(order)})"
    rows = (
        placed.withColumn("_pos", F.row_number().over(inside))
        .withColumn("_known", F.when(~gap, F.struct(F.col("_pos").alias("pos"), F.col("price").alias("price"))))
        .withColumns(
            {
                "_a": F.last("_known", ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0)),
                "_b": F.expr(ahead),
            }
        )
        .withColumns({"_a": F.when(gap, F.col("_a")), "_b": F.when(gap, F.col("_b")), "_placed": F.col("_place").isNotNull()})
        .select(*df.columns, *chunk[len(keys) :], "_pos", "_a", "_b", "_placed")
    )
    rows = stage(rows, "gaps")  # sorted once, read for the borders and for the result
    along = W.partitionBy(*keys).orderBy("_from", "_slot")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    moved = lambda name: F.when(
        F.col(name).isNotNull(),
        F.struct((F.col(f"{name}.pos") + F.col("_skip")).alias("pos"), F.col(f"{name}.price").alias("price")),
    )
    at = F.when(~gap, F.col("_pos"))
    end = lambda pos, price: F.when(pos.isNotNull(), F.struct(pos.alias("pos"), price.alias("price")))
    borders = (
        rows.groupBy(*chunk)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            end(F.min(at), F.min_by("price", at)).alias("_first"),
            end(F.max(at), F.max_by("price", at)).alias("_last"),
        )
        .withColumn("_skip", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumns({"_first": moved("_first"), "_last": moved("_last")})
        .withColumns(
            {
                "_prev_chunk": F.last("_last", ignorenulls=True).over(before),
                "_next_chunk": F.expr(f"lead(_first) ignore nulls over (partition by {quoted(keys) or 'null'} order by _from, _slot)"),
            }
        )
        .select(*chunk, "_skip", "_prev_chunk", "_next_chunk")
    )
    ends = (
        rows.join(stage(borders, "borders"), chunk)
        .withColumn("_at", F.col("_pos") + F.col("_skip"))
        .withColumns({"_a": F.coalesce(moved("_a"), F.col("_prev_chunk")), "_b": F.coalesce(moved("_b"), F.col("_next_chunk"))})
    )
    run = F.col("_b.pos") - F.col("_a.pos")
    line = F.col("_a.price") + (F.col("_b.price") - F.col("_a.price")) * (
        (F.col("_at") - F.col("_a.pos")) / run
    )
    filled = F.coalesce(F.col("price"), F.when(run > 0, line), F.col("_a.price"), F.col("_b.price"))
    # rows without a date or a tie count as positions, but have no place of their own
    return (
        ends.withColumn("price", filled).where("price is not null and _placed").select(*df.columns)
    )


def full_spans(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spans of over ``FULL`` rows, with those of their days that have as many: ``_cut_days``.

    A table of at most a row for each ``FULL`` rows.
    """
    counts = days.groupBy(*keys, "_span", "_day").agg(F.count(F.lit(1)).alias("_n"))
    cut = F.collect_list(F.when(F.col("_n") > FULL, F.col("_day")))
    spans = counts.groupBy(*keys, "_span").agg(F.sum("_n").alias("_rows"), cut.alias("_cut_days"))
    return spans.where(F.col("_rows") > FULL).drop("_rows")


IMPUTERS = {
    "interpolate": impute_interpolate,
    "mean": impute_mean,
    "median": impute_median,
    "drop": impute_drop,
}


def handle_missing(df: DataFrame, strategy: str = "interpolate") -> DataFrame:
    return IMPUTERS.get(strategy, impute_drop)(df)


def _ungrouped(keys: Sequence[str]) -> Column:
    """True on rows that belong to no group because a key is missing."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))


# A filter made from the prices of all rows, for any table with the same groups.
Rule = Callable[[DataFrame], DataFrame]


def rule_iqr(prices: DataFrame, k: float = 3.0, staged: bool = False) -> Rule:
    keys = present(prices, GROUP)
    probs = {"_q1": 0.25, "_q3": 0.75}
    quartiles = stage(group_quantiles(prices, keys, "price", probs, staged), "quartiles")
    reach = k * (F.col("_q3") - F.col("_q1"))

    def keep(df: DataFrame) -> DataFrame:
        inside = known(df, "price").between(F.col("_q1") - reach, F.col("_q3") + reach)
        return attach(df, quartiles, keys).where(inside | _ungrouped(keys)).select(*df.columns)

    return keep


def outlier_iqr(df: DataFrame, k: float = 3.0) -> DataFrame:
    """Keeps q1 - k·iqr <= price <= q3 + k·iqr of the row's group."""
    return rule_iqr(df, k)(df)


def rule_zscore(prices: DataFrame, threshold: float = 3.0) -> Rule:
    keys = present(prices, GROUP)
    price = known(prices, "price")
    figures = prices.groupBy(*keys).agg(F.avg(price).alias("_mean"), F.stddev_samp(price).alias("_sd"))
    moments = stage(figures, "moments")

    def keep(df: DataFrame) -> DataFrame:
        off = F.abs((known(df, "price") - F.col("_mean")) / F.col("_sd"))
        near = F.when(F.col("_sd") == 0, True).otherwise(off <= threshold)
        return attach(df, moments, keys).where(near | _ungrouped(keys)).select(*df.columns)

    return keep


def outlier_zscore(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Keeps |price - mean| <= threshold·std; a one-row group has no std and goes."""
    return rule_zscore(df, threshold)(df)


def outlier_isolation(
    df: DataFrame,
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    min_rows: int = 10,
    sample: int = SAMPLE,
) -> DataFrame:
    """Drops the rows that isolation trees on the price isolate soonest."""
    return rule_isolation(df, contamination, trees, seed, min_rows, sample)(df)


def rule_isolation(
    df: DataFrame,
    contamination: float = 0.05,
    trees: int = 100,
    seed: int = 42,
    min_rows: int = 10,
    sample: int = SAMPLE,
) -> Rule:
    """By group: the prices whose score is over the quantile 1 - contamination go.

    A row's score depends on its price alone, so trees see and score each
    distinct price of a group once; the score's cut-off quantile counts rows.
    """
    keys = present(df, GROUP)
    price = known(df, "price")
    priced = df.where(price.isNotNull()).dropna(subset=keys or None)
    group = keys or ["_all"]
    counted = priced.withColumn("_all", F.lit(1)).groupBy(*group, price.alias("price"))
    values = counted.agg(F.count(F.lit(1)).alias("_rows"))
    values = stage(spread(values, *group, "price"), "prices")
    # Equal to a hundredth of a cent means one sampling key; the tree still sees both.
    label = F.floor(F.col("price") * 10000).cast("bigint").cast("string")
    forest = stage(
        fit_forest(values, group, ["price"], label, trees=trees, seed=seed, weight="_rows", sample=sample), "forest"
    )
    scored = stage(add_isolation_score(values, forest, group, ["price"], "_score", sample), "price-scores")
    cut = weighted_quantile(scored, group, "_score", "_rows", 1 - contamination)
    sizes = scored.groupBy(*group).agg(F.sum("_rows").alias("_n"))
    limits = stage(cut.join(sizes, group), "cuts")
    bad = (
        scored.join(limits, group)
        .where((F.col("_n") >= (min_rows if keys else 0)) & (F.col("_score") > F.col("_cut")))
        .select(*keys, "price")
    )
    bad = stage(bad, "isolated")
    return lambda rows: rows.join(bad, [*keys, "price"], "left_anti").select(*rows.columns)


def weighted_quantile(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, prob: float
) -> DataFrame:
    """Interpolated quantile ``_cut`` of a column of distinct values with row counts.

    Equal-width classes of the value narrow each group to the classes that hold
    the wanted ranks before anything is ordered.
    """
    classes = 4096
    ends = stage(
        df.groupBy(*keys).agg(
            F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum(weight).alias("_n")
        ),
        "ends",
    )
    width = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-300))
    placed = df.join(ends, list(keys)).withColumn(
        "_class", F.least(F.floor((F.col(value) - F.col("_lo")) / width * classes), F.lit(classes - 1))
    )
    run = W.partitionBy(*keys).orderBy("_class").rowsBetween(W.unboundedPreceding, 0)
    h = F.lit(prob) * (F.col("_n") - 1)
    held = (
        placed.groupBy(*keys, "_class", "_n")
        .agg(F.sum(weight).alias("_w"))
        .withColumn("_upto", F.sum("_w").over(run))
        .withColumn("_before", F.col("_upto") - F.col("_w"))
        .where((F.col("_upto") > F.floor(h)) & (F.col("_before") <= F.ceil(h)))
        .select(*keys, "_class", "_before")
    )
    fine = W.partitionBy(*keys, "_class").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    merged = placed.join(held, [*keys, "_class"]).groupBy(*keys, "_class", "_before", "_n", value)
    ranked = (
        merged.agg(F.sum(weight).alias("_w"))
        .withColumn("_upto", F.col("_before") + F.sum("_w").over(fine))
        .withColumn("_from", F.col("_upto") - F.col("_w"))
    )
    at = lambda rank: F.min(
        F.when((F.col("_from") <= rank) & (rank < F.col("_upto")), F.col(value))
    )
    low, high = at(F.floor(h)), at(F.ceil(h))
    return ranked.groupBy(*keys).agg(
        (low + (high - low) * F.max(h - F.floor(h))).alias("_cut")
    )


def remove_outliers(df: DataFrame, method: str = "iqr", threshold: float = 3.0) -> DataFrame:
    """By method name; an unknown name leaves the rows as they are, with a warning."""
    return outlier_rule(df, method, threshold)(df)


def outlier_rule(prices: DataFrame, method: str, threshold: float, staged: bool = False) -> Rule:
    if method == "iqr":
        return rule_iqr(prices, threshold, staged)
    if method == "zscore":
        return rule_zscore(prices, threshold)
    if method == "isolation_forest":
        return rule_isolation(prices)
    warnings.warn(f"unknown outlier method {method!r}: no rows are removed", stacklevel=3)
    return lambda df: df


def rule_sparse(prices: DataFrame, min_rows: int | Column = 30) -> Rule:
    keys = present(prices, GROUP)
    if not keys:
        return lambda df: df
    full = prices.dropna(subset=keys).groupBy(*keys).count().where(F.col("count") >= min_rows)
    groups = stage(full.select(*keys), "groups")
    return lambda df: attach(df, groups, keys, "left_semi")


def filter_sparse_groups(df: DataFrame, min_rows: int | Column = 30) -> DataFrame:
    """Keeps the rows of groups with at least ``min_rows`` rows."""
    return rule_sparse(df, min_rows)(df)


def clean(
    df: DataFrame,
    settings: Settings = Settings(),
    as_of: Column | None = None,
    steps: dict[str, Observation] | None = None,
) -> DataFrame:
    """All cleaning steps in order.

    Rows with a missing key end up dropped by the last step in any case, so they
    go first. Groups and prices alone are staged; the outlier limits and group sizes come
    from them, and whole rows are never copied. ``steps`` is filled with an observation of
    the row count ``n`` after each step, counted along with the work and ready when
    the result has been written.
    """
    validate_table(df, ["date", "price"])
    keys = present(df, GROUP)

    def seen(rows: DataFrame, step: str) -> DataFrame:
        if steps is None:
            return rows
        steps[step] = Observation(step)
        return rows.observe(steps[step], F.count(F.lit(1)).alias("n"))

    typed = standardise_types(df, as_of, settings.keep_missing).dropna(subset=keys or None)
    rows = drop_exact_duplicates(seen(typed, "types"))
    if settings.keep_missing:
        rows = handle_missing(seen(rows, "duplicates"), settings.missing_strategy)
    prices = stage(rows.select(*keys, "price"), "prices")
    inliers = outlier_rule(prices, settings.outlier_method, settings.outlier_threshold, staged=True)
    full = rule_sparse(inliers(prices), settings.min_data_points)
    rows = seen(rows, "missing" if settings.keep_missing else "duplicates")
    return seen(full(seen(inliers(rows), "outliers")), "sparse groups")


def period_start(day: Column, freq: str) -> Column:
    day = F.to_date(day)
    if freq == "D":
        return day
    if freq == "W":
        return F.next_day(F.date_sub(day, 1), "Sun")
    return F.trunc(day, {"MS": "month", "QS": "quarter", "YS": "year"}[freq])


# Length of each period.
STEPS = {"D": "1 day", "W": "7 days", "MS": "1 month", "QS": "3 months", "YS": "1 year"}


def aggregate_monthly(df: DataFrame, freq: str = "MS") -> DataFrame:
    """Mean price, sample deviation and row count by product, region and period.

    Empty periods between a group's first and last get a row with no price and count 0.
    """
    require_columns(df, ["date", "product", "region", "price"])
    price = known(df, "price")
    observed = (
        df.dropna(subset=["date", *GROUP])
        .groupBy(*GROUP, period_start(F.col("date"), freq).alias("date"))
        .agg(
            F.avg(price).alias("price"),
            F.stddev_samp(price).alias("price_std"),
            F.count(price).alias("record_count"),
        )
    )
    return fill_periods(observed, freq)


def fill_periods(observed: DataFrame, freq: str = "MS") -> DataFrame:
    """A row for every period between a group's first and last: each row opens the run of
    periods up to the group's next row."""
    step = F.expr(f"interval {STEPS[freq]}")
    nxt = F.lead("date").over(W.partitionBy(*GROUP).orderBy("date"))
    last = F.coalesce(F.to_date(F.col("_next") - step), F.col("date"))
    own = lambda name: F.when(F.col("_day") == F.col("date"), F.col(name))
    return (
        observed.withColumn("_next", nxt)
        .withColumn("_day", F.explode(F.sequence("date", last, step)))
        .select(
            *GROUP,
            F.col("_day").alias("date"),
            own("price").alias("price"),
            own("price_std").alias("price_std"),
            F.coalesce(own("record_count"), F.lit(0)).alias("record_count"),
        )
    )
