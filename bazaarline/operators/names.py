"""Names for a whole table of requests: equal, else the first that holds the request or is held.

The rule is that of ``forecast.best_match``, case-blind. A text that holds another holds all of its
grams (three characters, or the whole text where it is shorter). So the held text is keyed
by one gram only, the one that fewest of the other texts have, the others by all their
grams; equal keys meet in an equi-join and are verified. Nothing compares all names with all requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.staging import stage

SIZE = 3


def grams(text: Column, n: int = SIZE) -> Column:
    """The distinct runs of ``n`` characters; of a shorter text none."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    run = lambda i: F.concat(*[F.get(letters, i + k) for k in range(n)])
    found = F.transform(F.sequence(F.lit(0), F.size(letters) - n), run)
    return F.array_distinct(F.when(F.size(letters) >= n, found).otherwise(F.array().cast("array<string>")))


def _own(text: Column) -> Column:
    """Grams that a text is keyed by: of ``SIZE`` characters, or the whole text."""
    return F.when(F.char_length(text) < SIZE, F.array(text)).otherwise(grams(text))


def _all(text: Column) -> Column:
    """Grams that a text can hold: of 1 to ``SIZE`` characters."""
    return F.concat(*[grams(text, n) for n in range(1, SIZE + 1)])


def _keyed(held: DataFrame, frequency: DataFrame) -> DataFrame:
    """Each held text with its rarest gram; a text with a gram that nothing has is left out."""
    own = held.select("text", F.explode(_own(F.col("text"))).alias("gram"))
    ranked = own.join(frequency, "gram", "left").groupBy("text")
    chosen = ranked.agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("_least")
    )
    return chosen.where("_least.n > 0").select("text", "_least.gram")


def _first(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("request").agg(F.min("name").alias("name"))


def best_matches(names: DataFrame, requests: DataFrame, column: str = "name", requested: str = "requested") -> DataFrame:
    """One row per distinct request (null included): ``requested`` and its ``name``, null where none matches.

    Missing names match nothing and a missing request matches nothing; an empty text is in
    every text; of several names the first in order counts.
    """
    wanted = requests.select(F.col(requested).alias("requested")).distinct()
    texts = stage(wanted.dropna().select(F.lower("requested").alias("text")).distinct(), "requests")
    # Names that differ by case only: the first stands for all.
    known = stage(
        names.select(F.col(column).alias("name")).dropna().groupBy(F.lower("name").alias("text")).agg(F.min("name").alias("name")),
        "names",
    )
    asked, long = texts.withColumnRenamed("text", "request"), F.char_length("text") > SIZE

    name_grams = stage(known.select("text", "name", F.explode(_all(F.col("text"))).alias("gram")), "name-grams")
    # An empty name is in every request, so requests have the empty gram too.
    found = F.concat(F.array(F.lit("")), _all(F.col("text")))
    request_grams = stage(texts.select("text", F.explode(found).alias("gram")), "request-grams")
    # An empty request is in every name: the first of all names stands for it.
    least = known.agg(F.min("name").alias("name")).dropna()
    by_gram = (
        name_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
        .unionByName(least.select(F.lit("").alias("gram"), F.lit(1).cast("bigint").alias("n"), "name"))
    )

    exact = asked.join(known, F.col("request") == F.col("text")).select("request", "name")
    # A request that is a gram is held by the names that have the gram.
    brief = asked.join(by_gram, F.col("request") == F.col("gram")).select("request", "name")
    within = (
        _keyed(texts.where(long), by_gram.select("gram", "n")).withColumnRenamed("text", "request")
        .join(name_grams, "gram").where(F.contains("text", "request")).select("request", "name")
    )
    frequency = request_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    around = (
        _keyed(known, frequency).join(known, "text")
        .join(request_grams.withColumnRenamed("text", "request"), "gram")
        .where(F.contains("request", "text")).select("request", "name")
    )
    parts = _first(brief.unionByName(within).unionByName(around))
    best = (
        exact.withColumn("_rank", F.lit(0)).unionByName(parts.withColumn("_rank", F.lit(1)))
        .groupBy("request").agg(F.min(F.struct("_rank", "name")).alias("_best"))
        .select("request", "_best.name")
    )
    return wanted.join(best, F.lower("requested") == F.col("request"), "left").select("requested", "name")
