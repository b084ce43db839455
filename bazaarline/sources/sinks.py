"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces the table; ``partition_by`` lets later reads skip folders."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers; missing values are empty."""
    df.write.mode("overwrite").option("header", True).csv(path)
