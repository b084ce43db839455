"""The next row of every row in the order of a key, without one task that sorts all."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def in_order(df: DataFrame, key: str, text: str, buckets: int | None = None) -> tuple[DataFrame, WindowSpec]:
    """``df`` (``key`` and ``text`` only) with ``bucket, guest`` and a window over it.

    Rows are cut into key ranges, and the first row of each range is a guest at the end of
    the range before it (the very first row after the last), so ``lead`` over the window
    crosses ranges. Drop guests when done. Order: key, nulls first, then the text's hash;
    a key that repeats is cut by that hash. The driver sees one key per range.
    """
    spark = df.sparkSession
    # several ranges to a task, as far as the list of bounds stays short: ranges hashed to
    # tasks then even out
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(tasks, min(8 * tasks, 2048))
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(text)).withColumn("_h", F.xxhash64(text))
    place = F.struct(F.col(key).alias("k"), F.col("_h").alias("h"))
    narrow = rows.select(key, "_h").repartitionByRange(buckets, key, "_h")
    firsts = narrow.groupBy(F.spark_partition_id()).agg(F.min(place).alias("p"))
    bounds = [r.p.asDict() for r in firsts.select("p").orderBy("p").collect()]

    struct = f"struct<k:{kind},h:bigint>"
    group = max(1, math.isqrt(len(bounds)))
    coarse = bounds[::group]
    fine = [bounds[i : i + group] for i in range(0, len(bounds), group)]
    parsed = lambda value, form: F.from_json(F.lit(json.dumps(value)), form)

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b <= place))

    outer = F.greatest(below(parsed(coarse, f"array<{struct}>")), F.lit(1))
    inner = below(F.element_at(parsed(fine, f"array<array<{struct}>>"), outer))
    bucket = (outer - 1) * group + inner - 1
    rows = rows.withColumn("bucket", F.greatest(bucket, F.lit(0)))
    first = F.element_at(parsed(bounds, f"array<{struct}>"), F.col("bucket") + 1)
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    before = F.struct(
        F.when(F.col("bucket") == 0, max(len(bounds) - 1, 0)).otherwise(F.col("bucket") - 1).alias("bucket"),
        F.when(F.col("bucket") == 0, 2).otherwise(1).alias("guest"),
    )
    places = F.when(first.eqNullSafe(place), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.withColumn("_at", F.explode(places)).select(key, text, "_h", "_at.bucket", "_at.guest")
    return dealt, Window.partitionBy("bucket").orderBy("guest", F.col(key).asc_nulls_first(), "_h")
