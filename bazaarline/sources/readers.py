"""Readers of market CSV files, JSON replies and Parquet tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .schemas import FOOD_BALANCE, MARKET_COLUMNS, MARKET_CSV, PRODUCER_PRICE


def scan_csv(spark: SparkSession, path: str, schema: str | None = MARKET_CSV) -> DataFrame:
    """Market price files with a header; with ``schema=None`` all columns are text."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def _scan_reply(
    spark: SparkSession, path: str, record: str, years: tuple[int, int] | None, multiline: bool
) -> DataFrame:
    replies = spark.read.schema(f"data ARRAY<STRUCT<{_fields(record)}>>").option("multiLine", multiline)
    try:
        rows = replies.json(path).select(F.explode("data").alias("r")).select("r.*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], record)
    if years:
        rows = rows.where(F.col("year").between(*years))
    return normalise_columns(rows)


def _fields(ddl: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split() for f in ddl.split(", ")))


def scan_json(
    spark: SparkSession,
    path: str,
    years: tuple[int, int] | None = None,
    item_codes: Sequence[str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Producer prices from replies ``{"data": [records]}``, one reply per line or file."""
    rows = _scan_reply(spark, path, PRODUCER_PRICE, years, multiline)
    return rows.where(F.col("item_code").isin(list(item_codes))) if item_codes else rows


def scan_food_balance(
    spark: SparkSession, path: str, years: tuple[int, int] | None = None, multiline: bool = False
) -> DataFrame:
    """Food balance records from such replies; no rows if the path does not exist."""
    return _scan_reply(spark, path, FOOD_BALANCE, years, multiline)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with underscores; ``value`` as a number, missing if it is none."""
    names = [re.sub(r"[\s\-]+", "_", c.lower()).strip("_") for c in df.columns]
    named = df.toDF(*names)
    if "value" not in names:
        return named
    return named.withColumn("value", _number("value"))


def _number(name: str) -> Column:
    return F.nanvl(F.trim(F.col(name).cast("string")).try_cast("double"), F.lit(None).cast("double"))


def standardise_source(df: DataFrame) -> DataFrame:
    """Standard names in standard order, typed date and prices, rows without either dropped.

    Of several headers with one standard name the first is kept; ``district``
    stands in for a missing ``market``.
    """
    place: dict[str, int] = {}
    for i, header in enumerate(df.columns):
        header = header.lower().strip()
        place.setdefault(MARKET_COLUMNS.get(header, header), i)
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = [c for c in MARKET_COLUMNS.values() if c in place]
    out = inner.select(*[F.col(f"c{place[c]}").alias(c) for c in kept])
    if "market" not in kept and "district" in kept:
        out = out.withColumnRenamed("district", "market")
    if "date" in kept and dict(out.dtypes)["date"] == "string":
        out = out.withColumn("date", F.try_to_timestamp("date").cast("timestamp_ntz"))
    out = out.withColumns({c: _number(c) for c in ("price", "price_usd") if c in kept})
    return out.dropna(subset=["price", "date"])


def sorted_by_date(df: DataFrame) -> DataFrame:
    """Total order for export: by date, then by the other columns."""
    return df.orderBy("date", *[c for c in df.columns if c != "date"])


def priority_union(real: DataFrame, fallback: DataFrame) -> DataFrame:
    """Real rows, and fallback rows of the regions that the real rows lack, with ``source``."""
    covered = real.select("region").distinct()
    rest = fallback.join(covered, "region", "left_anti").select(*fallback.columns)
    return real.withColumn("source", F.lit("WFP_real")).unionByName(
        rest.withColumn("source", F.lit("synthetic")), allowMissingColumns=True
    )


def market_locations(df: DataFrame) -> DataFrame:
    """One row per market: region and coordinates of its earliest row."""
    columns = [c for c in ("region", "latitude", "longitude") if c in df.columns]
    first = F.min(F.struct("date", *columns))
    return df.groupBy("market").agg(first.alias("_first")).select("market", *[f"_first.{c}" for c in columns])


def read_parquet_safe(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where there is no readable Parquet table."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def materialise_or_reuse(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> DataFrame:
    """The saved table if there is one, else ``build`` it, save it and read it back.

    A table counts as saved when its writer has finished it.
    """
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    finished = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)
    saved = read_parquet_safe(spark, path) if finished and not force else None
    if saved is not None:
        return saved
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
