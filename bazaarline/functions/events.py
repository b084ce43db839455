"""Calendar flags from tables of events of any length and number.

A month holds at most 31 days, so the days of a month that events cover are one number.
Events are cut into the months they touch and merged there by ``bit_or``; rows find their
month by an equi-join, one row to one row, however many events overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .staging import stage


def month_masks(events: DataFrame, keys: Sequence[str] = (), start: str = "start", end: str = "end") -> DataFrame:
    """One row per key and month that an event touches: first day and bits of the covered days.

    Both ends belong to the event. Events without an end or start, or that end before they
    start, cover nothing.
    """
    day = events.select(*keys, F.to_date(start).alias("_a"), F.to_date(end).alias("_b")).where("_a <= _b")
    month = F.explode(F.expr("sequence(trunc(_a, 'month'), trunc(_b, 'month'), interval 1 month)"))
    cut = day.withColumn("_month", month)
    first = F.when(F.trunc("_a", "month") == F.col("_month"), F.dayofmonth("_a")).otherwise(1)
    last = F.when(F.trunc("_b", "month") == F.col("_month"), F.dayofmonth("_b")).otherwise(31)
    days = F.expr("shiftleft(1L, _last) - shiftleft(1L, _first - 1)")
    return (
        cut.withColumns({"_first": first, "_last": last})
        .groupBy(*keys, "_month").agg(F.bit_or(days).alias("_mask"))
    )


def yearly_masks(days: DataFrame, keys: Sequence[str] = (), month: str = "month", day: str = "day") -> DataFrame:
    """The same for days that come back every year: one row per key and month number."""
    real = days.where(F.col(month).between(1, 12) & F.col(day).between(1, 31))
    number, bit = F.col(month).cast("int").alias("_month"), F.expr(f"shiftleft(1L, cast(`{day}` as int) - 1)")
    return real.groupBy(*keys, number).agg(F.bit_or(bit).alias("_mask"))


def _flag(df: DataFrame, masks: DataFrame, month, day: str, keys: Sequence[str], name: str) -> DataFrame:
    date = F.to_date(day)
    table = stage(masks, "events")
    bucket = table.select(*[F.col(k).alias(f"_event_{k}") for k in keys], F.col("_month").alias("_event_month"), F.col("_mask").alias("_event_mask"))
    same = F.col("_event_month") == month
    for k in keys:
        same = same & (F.col(f"_event_{k}") == F.col(k))
    bit = F.expr("shiftright(_event_mask, dayofmonth(_event_day) - 1) & 1")
    return (
        df.withColumn("_event_day", date).join(bucket, same, "left")
        .withColumn(name, F.coalesce(bit, F.lit(0)).cast("int"))
        .drop("_event_day", "_event_month", "_event_mask", *[f"_event_{k}" for k in keys])
    )


def add_event_flag(
    df: DataFrame, events: DataFrame, name: str, day: str = "date", keys: Sequence[str] = (),
    start: str = "start", end: str = "end",
) -> DataFrame:
    """``name``: 1 where an event of the row's ``keys`` covers its day, else 0 (also without a day).

    The merged months are staged, so the planner broadcasts them only while they are small.
    """
    return _flag(df, month_masks(events, keys, start, end), F.trunc(F.col("_event_day"), "month"), day, keys, name)


def add_yearly_flag(
    df: DataFrame, days: DataFrame, name: str, day: str = "date", keys: Sequence[str] = (),
    month_col: str = "month", day_col: str = "day",
) -> DataFrame:
    """``name``: 1 on the stated days of every year, else 0."""
    return _flag(df, yearly_masks(days, keys, month_col, day_col), F.month("_event_day"), day, keys, name)
