"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed. The ledger holds, by blob, the rule
versions that have scanned it and what they found. A run looks up which (blob, rule
version) pairs the ledger lacks, scans one row of each such blob by just those rules,
appends the findings, and joins them back to all paths that hold the blob. So a text
that many paths share is scanned once, a second run scans only new texts, and a changed
rule (a new version number) rescans by that rule alone.

Spans come from ``split`` and ``regexp_extract_all``: the lengths of the gaps and of the
matches, added up, are the positions in code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.staging import new_path, stage
from .names import fresh


@dataclass(frozen=True)
class Rule:
    """``least`` is the length that ``group`` of a match must have; ``test`` must match
    somewhere in a text with a finding and ``needle`` be part of it (both only save time)."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1
    test: str = ""
    needle: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"
#: The base kinds, in their fixed order. A maximal run that is long enough is the same
#: match as a run of any length that is then measured.
BASE = (
    Rule("assign", f"{_ASSIGN}({_VALUE}+)", group=2, least=8, test=f"{_ASSIGN}{_VALUE}{{8}}"),
    Rule("access", "AKIA[A-Z0-9]{12,}", needle="AKIA"),
    Rule("hex", "[0-9a-f]{32,}"),
)
#: Kinds beyond the base ones.
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", needle="PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", needle="gh"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", needle="xox"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needle="eyJ"),
)
RULES = BASE + MORE
FINDING = "struct<rule:string,kind:string,start:int,end:int>"
LEDGER = f"blob string, rules array<string>, findings array<{FINDING}>"


def spans(text: Column, rule: Rule, wanted: Column) -> Column:
    """Findings of one rule in a text, leftmost and non-overlapping; empty if not ``wanted``."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    lengths = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.char_length)
    measured = lengths
    if rule.group:
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        measured = F.transform(found, F.char_length)
    none = F.lit(None).cast(f"array<{FINDING}>")
    nothing = F.coalesce(none, F.array().cast(f"array<{FINDING}>"))

    def step(state: Column, match: Column) -> Column:
        start = state["at"] + match["gap"]
        end = start + match["length"]
        one = F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end")
        )
        out = F.when(match["measured"] >= rule.least, F.concat(state["out"], F.array(one)))
        return F.struct(end.alias("at"), out.otherwise(state["out"]).alias("out"))

    matches = F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(lengths)).alias("gap"), lengths.alias("length"), measured.alias("measured")
    )
    start = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    positions = F.aggregate(matches, start, step, lambda state: state["out"])
    hit = F.rlike(text, F.lit(rule.test or rule.pattern))
    if rule.needle:
        hit = F.contains(text, F.lit(rule.needle)) & hit
    return F.when(wanted & hit, positions).otherwise(nothing)


def ledger_at(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty where nothing has been written yet."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def extend(versions: DataFrame, texts: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger at ``path`` lacks and append it.

    ``versions``: ``key, blob``; ``texts``: ``key, blob, text``. One row stands for all of a
    blob, found by a partial aggregate; its text alone is moved, by key, which is even.
    """
    spark = versions.sparkSession
    known = ledger_at(spark, path).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("known"))
    all_rules = F.array(*(F.lit(r.name) for r in rules))
    missing = F.array_except(all_rules, F.coalesce("known", F.array().cast("array<string>")))
    blobs = versions.groupBy("blob").agg(F.min("key").alias("key"))
    unseen = blobs.join(known, "blob", "left").select("blob", "key", missing.alias("rules")).where(F.size("rules") > 0)
    picked = texts.alias("t").join(
        unseen.alias("u"), F.col("t.key").eqNullSafe(F.col("u.key")) & (F.col("t.blob") == F.col("u.blob"))
    )
    picked = picked.select("u.blob", "u.rules", "t.text")
    found = [spans(F.col("text"), r, F.array_contains("rules", r.name)) for r in rules]
    scanned = picked.select("blob", "rules", F.concat(*found).alias("findings"))
    scanned.dropDuplicates(["blob"]).write.mode("append").parquet(path)


def findings(
    df: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``key, blob, findings`` of every row of ``df``: all spans of the given rule versions.

    ``path`` is the ledger's place; by default a new one in the shared folder. Null texts
    are empty. Rows whose key is null or repeats are kept as they are.
    """
    spark = df.sparkSession
    path = path or new_path(spark, "ledger")
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(F.col(key).alias("key"), F.sha2(whole, 256).alias("blob"), whole.alias("text"))
    versions = stage(texts.select("key", "blob"), "versions")
    extend(versions, texts, path, rules)
    names = [r.name for r in rules]
    current = F.filter("findings", lambda f: f["rule"].isin(*names))
    by_blob = (
        ledger_at(spark, path)
        .select("blob", current.alias("findings"))
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.flatten(F.collect_list("findings")).alias("findings"))
    )
    hits = stage(by_blob.select(F.col("blob").alias("hit"), "findings"), "findings")
    joined = versions.join(hits, F.col("blob") == F.col("hit"), "left")
    nothing = F.array().cast(f"array<{FINDING}>")
    return joined.select(
        F.col("key").alias(key), "blob", F.coalesce("findings", nothing).alias("findings")
    )


def listed(found: Column | str, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of the given kinds by start, then kind in that order, comma-joined."""
    order = F.array(*(F.lit(k) for k in kinds))
    place = lambda f: F.array_position(order, f["kind"])
    own = F.filter(found, lambda f: place(f) > 0)
    sortable = F.transform(
        own, lambda f: F.struct(f["start"].alias("s"), place(f).alias("o"), f["end"].alias("e"), f["kind"].alias("k"))
    )
    return F.array_join(F.transform(F.array_sort(sortable), lambda f: F.concat_ws(":", f["k"], f["s"], f["e"])), ",")


def masked(text: Column, found: Column) -> Column:
    """The text with every span overwritten by ``*``; lengths and positions stay."""
    return F.aggregate(
        found,
        text,
        lambda whole, f: F.concat(
            F.substring(whole, F.lit(1), f["start"]),
            F.repeat(F.lit("*"), f["end"] - f["start"]),
            F.substring(whole, f["end"] + 1, F.char_length(whole)),
        ),
    )


def mask(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with its secrets overwritten; all rows and columns stay, null texts stay null."""
    found = findings(df, path, key, text).where(F.size("findings") > 0)
    hit, spans_ = fresh(df, "_hit"), fresh(df, "_found")
    by_blob = found.select("blob", "findings").dropDuplicates(["blob"])
    hits = stage(by_blob.select(F.col("blob").alias(hit), F.col("findings").alias(spans_)), "hits")
    joined = df.join(hits, F.sha2(F.coalesce(F.col(text), F.lit("")), 256) == F.col(hit), "left")
    new = F.when(F.col(hit).isNull(), F.col(text)).otherwise(masked(F.col(text), F.col(spans_)))
    return joined.select(*(new.alias(c) if c == text else F.col(c) for c in df.columns))
