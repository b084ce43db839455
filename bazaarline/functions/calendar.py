"""Calendar columns: parts of the date, seasons, Ramadan, holidays, cyclical codes."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# First and last day of Ramadan by year.
RAMADAN = {
    2020: ("2020-04-23", "2020-05-23"),
    2021: ("2021-04-12", "2021-05-12"),
    2022: ("2022-04-01", "2022-05-01"),
    2023: ("2023-03-22", "2023-04-21"),
    2024: ("2024-03-10", "2024-04-09"),
    2025: ("2025-02-28", "2025-03-30"),
    2026: ("2026-02-17", "2026-03-19"),
    2027: ("2027-02-06", "2027-03-08"),
    2028: ("2028-01-26", "2028-02-24"),
    2029: ("2029-01-14", "2029-02-13"),
    2030: ("2030-01-03", "2030-02-02"),
}

# First day of Ramadan by year, for the 30-day calendar of the board.
RAMADAN_STARTS = {
    2015: "2015-06-17",
    2016: "2016-06-05",
    2017: "2017-05-26",
    2018: "2018-05-15",
    2019: "2019-05-05",
    2020: "2020-04-23",
    2021: "2021-04-12",
    2022: "2022-04-01",
    2023: "2023-03-22",
    2024: "2024-03-10",
}
BOARD_RAMADAN = {
    year: (first, str(date.fromisoformat(first) + timedelta(days=29)))
    for year, first in RAMADAN_STARTS.items()
}

# Public holidays as (month, day).
HOLIDAYS = [(1, 1), (5, 1), (7, 5), (7, 19), (11, 1)]

# Season names for Dec-Feb, Mar-May, Jun-Aug, Sep-Nov.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")
SEASONS_FR = ("Hiver", "Printemps", "Été", "Automne")


def is_ramadan(day: Column, calendar: dict[int, tuple[str, str]] = RAMADAN) -> Column:
    """1 inside the given periods (ends included), else 0; unknown years give 0."""
    day = F.to_date(day)
    inside = [
        day.between(F.lit(date.fromisoformat(a)), F.lit(date.fromisoformat(b)))
        for a, b in calendar.values()
    ]
    return F.coalesce(reduce(lambda x, y: x | y, inside), F.lit(False)).cast("int")


def is_holiday(day: Column) -> Column:
    code = F.month(day) * 100 + F.dayofmonth(day)
    return F.coalesce(code.isin([m * 100 + d for m, d in HOLIDAYS]), F.lit(False)).cast("int")


def season(day: Column, labels: tuple[str, str, str, str] = SEASONS) -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(12, 1, 2), labels[0])
        .when(month.between(3, 5), labels[1])
        .when(month.between(6, 8), labels[2])
        .when(month.between(9, 11), labels[3])
    )


def cycle(part: Column, period: int) -> tuple[Column, Column]:
    angle = part * (2 * F.pi() / period)
    return F.sin(angle), F.cos(angle)


def add_temporal_features(
    df: DataFrame,
    date_col: str = "date",
    calendar: dict[int, tuple[str, str]] = RAMADAN,
    seasons: tuple[str, str, str, str] = SEASONS,
) -> DataFrame:
    """Calendar columns of ``date_col``; a narrow projection without any join."""
    day = F.to_date(F.col(date_col))
    month_sin, month_cos = cycle(F.month(day), 12)
    dow_sin, dow_cos = cycle(F.weekday(day), 7)
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "week": F.weekofyear(day),
            "day_of_week": F.weekday(day),
            "day_of_year": F.dayofyear(day),
            "quarter": F.quarter(day),
            "is_weekend": F.weekday(day).isin(4, 5).cast("int"),
            "season": season(day, seasons),
            "is_ramadan": is_ramadan(day, calendar),
            "is_holiday": is_holiday(day),
            "month_sin": month_sin,
            "month_cos": month_cos,
            "dow_sin": dow_sin,
            "dow_cos": dow_cos,
        }
    )
