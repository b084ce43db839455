"""Settings of a session that hold for one step."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` hold inside; use it around what runs a query, such as ``stage``."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def released(spark: SparkSession):
    """Each query that ends inside deletes its shuffle files.

    What is staged needs them no more, and a later step has the disk for itself.
    """
    return settings(spark, {CLEANUP: "true"})
