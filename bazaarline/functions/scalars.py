"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given column names that ``df`` has, in the given order."""
    return [n for n in names if n in df.columns]


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.nanvl(F.col(name), F.lit(None))
    return F.col(name)


def snap(x: Column, digits: int = 4) -> Column:
    """Fixed-point value that does not depend on the order of summation."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5001) / scale


def ratio(a: Column, b: Column) -> Column:
    """a / b, missing where b is zero."""
    return F.try_divide(a, b)


def hash_unit(key: Column, start: int = 1) -> Column:
    """A number in [0, 1) from eight hex digits of the key's md5."""
    digits = F.substring(F.md5(key), start, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))


def format_price(price: Column, currency: str = "DZD") -> Column:
    return F.concat(F.format_number(price, 2), F.lit(f" {currency}"))


def signed_percent(change: Column) -> Column:
    """'+5.2%' or '-3.1%'; missing stays missing."""
    sign = F.when(change >= 0, "+").when(change < 0, "-")
    return F.concat(sign, F.format_string("%.1f%%", F.round(F.abs(change), 1)))
