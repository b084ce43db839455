"""Connected components of a link table by alternating star contractions.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest
node it sees. Rounds end when no link changes; their number grows with the logarithm of
the longest chain. A hub's links are only ever counted by partial aggregates or joined
with a staged table, so adaptive execution can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.staging import new_path, stage


def _hang(links: DataFrame, least: DataFrame) -> DataFrame:
    return links.join(least.withColumnRenamed("u", "at"), F.col("u") == F.col("at"))


def _larger(links: DataFrame) -> DataFrame:
    """``u, v`` with u > v: each node's larger neighbours hang on its smallest one."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    hung = _hang(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.distinct()


def _smaller(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of them."""
    least = stage(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    neighbours = _hang(links, least).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return neighbours.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of every node that has a link; the root is the component's smallest node.

    Links from a node to itself and repeated links are allowed; null ends are ignored.
    """
    spark = links.sparkSession
    now = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    seen = None
    while True:
        now = stage(_larger(now), "links")
        mark = Observation()
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
        path = new_path(spark, "links")
        _smaller(now).observe(mark, F.count("*").alias("n"), digest).write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        state = mark.get
        if state == seen or not state.get("n"):
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
