"""Price observations and panels made from the TPC-H-like tables."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.staging import stage, work_dir
from ..operators.cleaning import aggregate_monthly
from ..operators.features import pct_change_features
from ..operators.anomaly import score_panel
from ..settings import Settings
from ..sources.incremental import source_files
from ..sources.readers import materialise_or_reuse

#: The tables behind the observations.
SOURCES = ["lineitem", "part", "supplier", "nation", "region"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: unit price of a brand in the supplier's nation and region.

    The dimension tables grow with the data; the planner broadcasts those whose
    file size allows it.
    """
    table = lambda name: read(spark, sf_dir, name)
    quantity, gross = F.col("l_quantity"), F.col("l_extendedprice")
    return (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_shipdate").alias("date"),
            F.col("p_brand").alias("product"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("market"),
            F.col("p_type").alias("category"),
            (F.col("n_nationkey") + 20.0).alias("latitude"),
            (F.col("n_nationkey") * 0.5 - 5.0).alias("longitude"),
            (gross / quantity).alias("price"),
            (gross * (1 - F.col("l_discount")) / quantity).alias("price_usd"),
        )
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("date", "product", "region", "price")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly panel with its empty months."""
    return aggregate_monthly(prices(spark, sf_dir))


def known_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that have a price."""
    rows = panel(spark, sf_dir).where("price is not null")
    return rows.select("product", "region", "date", "price")


def gap_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with prices blanked by a rule: inside, before and after a series."""
    size = F.length("product")
    blank = (
        ((F.year("date") * 12 + F.month("date") + size) % 7 == 0)
        | ((size == 7) & (F.col("date") < "1995-04-01"))
        | ((size == 8) & (F.col("date") >= "2001-09-01"))
    )
    return panel(spark, sf_dir).select(
        "product", "region", "date", F.when(~blank, F.col("price")).alias("price")
    )


def gap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with every seventh order's prices blanked."""
    rows = observations(spark, sf_dir)
    blank = F.col("order_key") % 7 == 0
    return rows.select(
        "date", "product", "region", "market", F.when(~blank, F.col("price")).alias("price")
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pct_change_features(known_panel(spark, sf_dir), (1,))


def version(spark: SparkSession, sources: Sequence[str], settings: Settings = Settings()) -> str:
    """Digest of settings and of the files under some paths: names, lengths and times of change.

    Tasks list the files and hash them; one sum of each path's hashes comes to the driver.
    """
    marks = [F.col("file"), F.col("length"), F.col("modified")]
    parts = [repr(settings)]
    for source in sources:
        each = source_files(spark, source).select(F.xxhash64(*marks).cast("decimal(38,0)").alias("mark"))
        parts.append(f"{source} {each.agg(F.count('*'), F.sum('mark')).first()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def scored_panel(spark: SparkSession, sf_dir: str, settings: Settings = Settings(), path: str | None = None) -> DataFrame:
    """The scored panel, kept in the shared folder for as long as tables and settings stay the same.

    ``path`` names a scored table of the caller's own, which is then read or made as it is.
    """
    rows = changes(spark, sf_dir)
    path = path or f"{work_dir(spark)}/scored-{version(spark, [f'{sf_dir}/{t}.parquet' for t in SOURCES], settings)}"
    return materialise_or_reuse(spark, path, lambda: score_panel(stage(rows, "panel"), settings))
