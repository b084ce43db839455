"""Column names that a table doesn't have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
