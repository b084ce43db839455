"""The monthly panel kept up to date from the files that changed.

A state folder holds, for every file of the source and every series and period in it, the
count, mean and sum of squared deviations of its prices. These merge over files, so a new
file adds its rows, a replaced file's rows take the place of its old ones, and a removed
file's rows go; no other file is read again.

Layout: ``parts/<id>`` are Parquet tables of such figures, ``manifests/<n>`` lists the
files that count (path, length, time of change) and the part that holds each one's figures.
A manifest is written after its part, and the latest finished one holds: a refresh that is
lost half way leaves nothing but an unused part. Two refreshes of one state at a time end
in an error for the later one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cleaning import GROUP, fill_periods, known, period_start

#: Columns that the library adds to the source's own.
FILE = "_source_file"
#: Fixed names: what tells one version of a file from another.
MARKS = ["file", "length", "modified"]


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _readable(file: str) -> str:
    """The path as a reader takes it: not URL-encoded, and no glob."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def _names(spark: SparkSession, folder: str) -> list[str]:
    path, system = _path(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def _finished(spark: SparkSession, state: str) -> list[str]:
    """Names of the manifests whose writer has finished, oldest first."""
    def done(name: str) -> bool:
        path, system = _path(spark, f"{state}/manifests/{name}/_SUCCESS")
        return system.exists(path)

    return [n for n in _names(spark, f"{state}/manifests") if done(n)]


def source_files(spark: SparkSession, source: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file: path, length and time of change; no file is opened.

    Statuses are asked for by tasks, not by the driver in turn.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    marks = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ]
    return files.option("pathGlobFilter", pattern).load(source).select(marks)


def changed_files(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """The files that the manifest lacks or knows in another version."""
    return files if manifest is None else files.join(manifest, MARKS, "left_anti")


def figures(rows: DataFrame, freq: str = "MS") -> DataFrame:
    """Count, mean and sum of squared deviations by file, series and period.

    Rows without date, product or region count for nothing, as in ``aggregate_monthly``.
    """
    price = known(rows, "price")
    return (
        rows.dropna(subset=["date", *GROUP])
        .groupBy(F.col(FILE).alias("file"), *GROUP, period_start(F.col("date"), freq).alias("date"))
        .agg(
            F.count(price).alias("n"),
            F.avg(price).alias("mean"),
            (F.var_pop(price) * F.count(price)).alias("m2"),
        )
    )


def merged(states: DataFrame) -> DataFrame:
    """Mean, sample deviation and count by series and period over all files.

    Deviations are taken from the common mean, which is joined back, so large prices with
    small spreads lose no digits.
    """
    keys = [*GROUP, "date"]
    totals = states.groupBy(*keys).agg(
        F.sum("n").alias("record_count"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("price"),
    )
    shift = F.col("mean") - F.col("price")
    spread = states.join(totals, keys).groupBy(*keys).agg(
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("m2")
    )
    deviation = F.when(F.col("record_count") > 1, F.sqrt(F.col("m2") / (F.col("record_count") - 1)))
    return totals.join(spread, keys).select(
        *keys, "price", deviation.alias("price_std"), "record_count"
    )


def _manifest(spark: SparkSession, state: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{state}/manifests/{name}")


def _states(spark: SparkSession, state: str, manifest: DataFrame) -> DataFrame:
    """Figures of the files that the manifest lists, from the parts it names."""
    parts = [r.part for r in manifest.select("part").distinct().collect()]  # at most ``most_parts``
    tables = spark.read.option("basePath", f"{state}/parts").parquet(*[f"{state}/parts/part={p}" for p in parts])
    return tables.join(manifest.select("file", "part"), ["file", "part"], "left_semi")


def refresh(
    spark: SparkSession,
    source: str,
    state: str,
    rows: Callable[[DataFrame], DataFrame] = lambda scan: scan,
    freq: str = "MS",
    version: str = "1",
    pattern: str = "*.parquet",
    most_parts: int = 32,
) -> list[str]:
    """Bring the state up to the source's files; the paths that were read.

    ``rows`` makes date, product, region and price of the scan of the changed files and must
    keep the column ``_source_file``; it may join dimensions. What the figures depend on
    beside the files (dimensions, rules of ``rows``) goes into ``version``: another version or
    ``freq`` reads every file anew. Beyond ``most_parts`` parts the live figures are written
    into one. The driver holds the paths of the changed files, as Spark's own index does.
    """
    stamp = f"{version}/{freq}"
    names = _finished(spark, state)
    before = _manifest(spark, state, names[-1]).where(F.col("version") == stamp) if names else None
    files = source_files(spark, source, pattern)
    listed = f"{state}/listings/{uuid.uuid4().hex}"
    files.write.parquet(listed)
    files = spark.read.parquet(listed)
    changed = changed_files(files, before)
    paths = sorted(r.file for r in changed.select("file").collect())
    part = uuid.uuid4().hex
    entries = None
    if before is not None:
        entries = files.join(before.select(*MARKS, "part"), MARKS)
    if paths:
        scan = spark.read.option("basePath", source).parquet(*map(_readable, paths))
        figures(rows(scan.withColumn(FILE, F.col("_metadata.file_path"))), freq).write.parquet(f"{state}/parts/part={part}")
        fresh = changed.withColumn("part", F.lit(part))
        entries = fresh if entries is None else entries.unionByName(fresh)
    if entries is not None:
        number = f"{int(names[-1]) + 1 if names else 1:09d}"
        live = entries.select("part").distinct().count()
        if live > most_parts:
            whole = uuid.uuid4().hex
            _states(spark, state, entries).drop("part").write.parquet(f"{state}/parts/part={whole}")
            entries = entries.withColumn("part", F.lit(whole))
        entries.withColumn("version", F.lit(stamp)).write.parquet(f"{state}/manifests/{number}")
        _tidy(spark, state)
    path, system = _path(spark, f"{state}/listings")
    system.delete(path, True)
    return paths


def _tidy(spark: SparkSession, state: str) -> None:
    """Delete manifests before the last two and parts that neither names.

    A panel that is being read from the manifest before stays whole.
    """
    names = _finished(spark, state)
    used = {f"part={r.part}" for n in names[-2:] for r in _manifest(spark, state, n).select("part").distinct().collect()}
    gone = [f"manifests/{n}" for n in names[:-2]]
    gone += [f"parts/{n}" for n in _names(spark, f"{state}/parts") if n not in used]
    for name in gone:
        path, system = _path(spark, f"{state}/{name}")
        system.delete(path, True)


def panel(spark: SparkSession, state: str, freq: str = "MS") -> DataFrame:
    """The panel of the last refresh; equals ``aggregate_monthly`` over all files' rows."""
    names = _finished(spark, state)
    if not names:
        raise ValueError(f"{state} holds no finished refresh")
    manifest = _manifest(spark, state, names[-1])
    stored = manifest.first()
    if stored is None:
        raise ValueError(f"the last refresh of {state} found no files")
    if not stored.version.endswith(f"/{freq}"):
        raise ValueError(f"{state} is kept by another period than {freq}")
    return fill_periods(merged(_states(spark, state, manifest)), freq)
