"""Checks of a table's columns and size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

#: Rows that a limit may bring to one task.
FEW = 10_000


def require_columns(df: DataFrame | None, required: Sequence[str]) -> None:
    """Schema check only; starts no job."""
    if df is None or not df.columns:
        raise ValueError("DataFrame is None or empty.")
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def validate_table(df: DataFrame | None, required: Sequence[str], min_rows: int = 1) -> bool:
    """Columns as above, and at least ``min_rows`` rows.

    Up to ``FEW`` rows no more than that are read; beyond it all are counted, in every task,
    since a limit would bring its rows to one.
    """
    if df is not None and df.columns and df.isEmpty():
        raise ValueError("DataFrame is None or empty.")
    require_columns(df, required)
    if min_rows > 1:
        narrow = df.select(df.columns[0])
        seen = (narrow.limit(min_rows) if min_rows <= FEW else narrow).count()
        if seen < min_rows:
            raise ValueError(f"DataFrame has {seen} rows, expected at least {min_rows}.")
    return True
