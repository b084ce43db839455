from datetime import date

import pytest
from pyspark.sql import functions as F

from bazaarline.functions.calendar import add_temporal_features, is_holiday, is_ramadan, season
from bazaarline.functions.scalars import format_price, signed_percent
from conftest import months


def value(spark, column):
    return spark.range(1).select(column.alias("v")).head().v


@pytest.mark.parametrize("day, want", [("2023-03-25", 1), ("2023-03-22", 1), ("2023-04-21", 1), ("2023-04-22", 0), ("2023-07-01", 0), ("2050-06-01", 0)])
def test_ramadan(spark, day, want):
    assert value(spark, is_ramadan(F.lit(day))) == want


@pytest.mark.parametrize("day, want", [("2023-07-05", 1), ("2023-11-01", 1), ("2024-05-01", 1), ("2023-03-15", 0)])
def test_holidays(spark, day, want):
    assert value(spark, is_holiday(F.lit(day))) == want


def test_seasons(spark):
    names = [value(spark, season(F.lit(date(2023, m, 15)))) for m in range(1, 13)]
    assert names == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


def test_columns(spark):
    df = spark.createDataFrame([(d,) for d in months(date(2022, 1, 1), 24)], "date date")
    out = add_temporal_features(df)
    for name in ("year", "month", "season", "is_ramadan", "is_holiday", "month_sin", "month_cos"):
        assert name in out.columns
    assert out.where("month_sin not between -1 and 1 or month_cos not between -1 and 1").count() == 0
    assert {r[0] for r in out.select("is_ramadan").collect()} == {0, 1}
    monday = add_temporal_features(spark.createDataFrame([(date(2024, 1, 1),)], "date date")).head()
    assert (monday.day_of_week, monday.week, monday.is_weekend) == (0, 1, 0)


def test_text(spark):
    assert value(spark, format_price(F.lit(1234.5))) == "1,234.50 DZD"
    assert value(spark, signed_percent(F.lit(5.2))) == "+5.2%"
    assert value(spark, signed_percent(F.lit(-3.1))) == "-3.1%"
    assert value(spark, signed_percent(F.lit(None).cast("double"))) is None
