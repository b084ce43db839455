"""Windows over series of any length: date-range chunks with halo rows.

A window by (product, region) puts a series in one task. Here a series is cut into
chunks of ``days`` days, and each chunk gets the last ``halo`` rows before it as guests.
A chunk then is a series of its own to every operator whose window reaches back at
most ``halo`` rows: lags, rolling figures, changes and the detector's features. Results
equal those of the plain operators.

Guests come from the tails of the chunks, at most ``halo`` rows of each, and find their
chunk by an equi-join on the number of tail rows before it. Only that table of tails is put
in order by series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.calendar import add_temporal_features
from ..functions.quantiles import attach, group_quantiles
from ..functions.scalars import known, ratio
from ..functions.staging import stage
from ..sources.validate import require_columns
from .anomaly import detection_features
from .features import CHANGES, GROUP, LAGS, WINDOWS, lag_features, pct_change_features, rolling_features

#: Days in a chunk: ten years.
DAYS = 3653


def chunk_of(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days)


def carried(tails: DataFrame) -> DataFrame:
    """Tail rows with ``_held``: the last known price up to them, of any earlier chunk too."""
    series = W.partitionBy(*GROUP).orderBy("_chunk")
    ends = tails.groupBy(*GROUP, "_chunk").agg(F.max("_last_known").alias("_last_known"))
    before = F.last("_last_known", ignorenulls=True).over(series.rowsBetween(W.unboundedPreceding, -1))
    ends = ends.select(*GROUP, "_chunk", before.alias("_before"))
    joined = tails.join(ends, [*GROUP, "_chunk"])
    return joined.withColumn("_held", F.coalesce("_known_so_far", F.col("_before")))


def with_halo(df: DataFrame, halo: int, days: int = DAYS, fill: bool = False) -> DataFrame:
    """``df`` with ``_chunk`` and, marked by ``_guest``, the rows before each chunk.

    With ``fill`` a guest's missing price is the last known one of the series. Rows without
    a product, region or date are in a chunk of their own, without guests.
    """
    rows = df.withColumns({"_chunk": chunk_of(F.col("date"), days), "_guest": F.lit(False)})
    chunk = W.partitionBy(*GROUP, "_chunk")
    so_far = chunk.orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.dropna(subset=[*GROUP, "date"]).withColumns(
        {
            "_back": F.row_number().over(chunk.orderBy(F.col("date").desc())),
            "_known_so_far": F.last("price", ignorenulls=True).over(so_far),
        }
    )
    # the newest row of a chunk holds what is known at its end
    tails = placed.where(F.col("_back") <= halo).withColumn("_last_known", F.when(F.col("_back") == 1, F.col("_known_so_far")))
    tails = stage(tails.drop("_back", "_guest"), "tails")
    if fill:
        tails = carried(tails).withColumn("price", F.col("_held")).drop("_before", "_held")
    tails = tails.drop("_known_so_far", "_last_known")
    series = W.partitionBy(*GROUP).orderBy("date")
    tails = tails.withColumn("_place", F.row_number().over(series))
    # a chunk's guests are the last ``halo`` of the tail rows before its own
    firsts = tails.groupBy(*GROUP, "_chunk").agg((F.min("_place") - 1).alias("_before"))
    firsts = firsts.where("_before > 0").withColumnRenamed("_chunk", "_next")
    offered = tails.withColumn("_before", F.explode(F.sequence(F.col("_place"), F.col("_place") + halo - 1)))
    guests = offered.join(firsts, [*GROUP, "_before"]).withColumns({"_chunk": F.col("_next"), "_guest": F.lit(True)})
    return rows.unionByName(guests.select(*rows.columns))


def by_chunk(df: DataFrame, step: Callable[[DataFrame], DataFrame], halo: int, days: int = DAYS, fill: bool = False) -> DataFrame:
    """``step`` applied to every chunk as if it were a series; guests are gone afterwards."""
    held = with_halo(df, halo, days, fill)
    own = held.withColumn("region", F.struct(F.col("region").alias("name"), F.col("_chunk").alias("chunk"))).drop("_chunk")
    made = step(own).where(~F.col("_guest")).drop("_guest")
    return made.withColumn("region", F.col("region")["name"])


def long_lags(df: DataFrame, lags: Sequence[int] = LAGS, days: int = DAYS) -> DataFrame:
    return by_chunk(df, lambda rows: lag_features(rows, lags), max(lags), days)


def long_rolling(df: DataFrame, windows: Sequence[int] = WINDOWS, days: int = DAYS) -> DataFrame:
    return by_chunk(df, lambda rows: rolling_features(rows, windows), max(max(windows) - 1, 1), days)


def long_changes(df: DataFrame, steps: Sequence[int] = CHANGES, days: int = DAYS) -> DataFrame:
    return by_chunk(df, lambda rows: pct_change_features(rows, steps), max(steps), days, fill=True)


def long_detection(df: DataFrame, window: int = 6, days: int = DAYS) -> DataFrame:
    return by_chunk(df, lambda rows: detection_features(rows, window), max(window - 1, 1), days)


# ---- figures of whole series ---------------------------------------------------


def joined_figures(df: DataFrame, figures: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Rows with their group's figures. A staged table's size is known: it is broadcast
    where small, and a hot group's rows are split where it is not. Null keys find none."""
    return attach(df, stage(figures, "figures"), keys)


def long_normalise(df: DataFrame, method: str = "minmax") -> DataFrame:
    """``price_norm`` as ``features.normalise`` gives it, without a window over a series.

    Least, greatest, mean and deviation are partial aggregates; quartiles come from
    ``group_quantiles``. An unknown method means min-max.
    """
    price = F.col("price")
    if method == "standard":
        figures = df.groupBy(*GROUP).agg(F.avg(price).alias("_centre"), F.stddev_pop(price).alias("_spread"))
    elif method == "robust":
        quarters = group_quantiles(df, GROUP, "price", {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75})
        figures = quarters.select(*GROUP, F.col("_q2").alias("_centre"), (F.col("_q3") - F.col("_q1")).alias("_spread"))
    else:
        figures = df.groupBy(*GROUP).agg(F.min(price).alias("_centre"), (F.max(price) - F.min(price)).alias("_spread"))
    spread = F.when(F.col("_spread") == 0, 1.0).otherwise(F.col("_spread"))
    joined = joined_figures(df, figures)
    return joined.withColumn("price_norm", (price - F.col("_centre")) / spread).drop("_centre", "_spread")


def long_normalise_score(df: DataFrame, raw: str, out: str = "score", keys: Sequence[str] = GROUP) -> DataFrame:
    """Flips a score whose low values are odd, then min-max by group; a constant gives 0."""
    figures = df.groupBy(*keys).agg(F.min(raw).alias("_low"), F.max(raw).alias("_high"))
    low, high, value = F.col("_low"), F.col("_high"), F.col(raw)
    flipped = F.when(high == low, 0.0).otherwise((high - value) / (high - low))
    return joined_figures(df, figures, keys).withColumn(out, flipped).drop("_low", "_high")


def long_national(df: DataFrame) -> DataFrame:
    """Price over the mean price of all regions on that date."""
    means = df.dropna(subset=["product", "date"]).groupBy("product", "date").agg(F.avg("price").alias("_national"))
    joined = joined_figures(df, means, ["product", "date"])
    return joined.withColumn("price_vs_national", ratio(F.col("price"), F.col("_national"))).drop("_national")


def build_long_features(df: DataFrame, method: str = "minmax", days: int = DAYS) -> DataFrame:
    """``features.build_features`` for series that are too long for one task."""
    require_columns(df, ["date", "product", "region", "price"])
    rows = stage(long_national(df.withColumn("price", known(df, "price"))), "rows")
    windows = by_chunk(rows, lambda part: rolling_features(lag_features(part)), max(LAGS), days)
    changed = long_changes(stage(windows, "windows"), days=days)
    return add_temporal_features(long_normalise(stage(changed, "changes"), method))
