"""WARC archives: writing with revisit records, reading by boundary chains.

An archive is cut at every occurrence of the version line's start, wherever tasks find one: in
record headers (versions 1.0 and 1.1) and, as likely, inside payloads. Every cut is a candidate record; its
header's Content-Length gives the offset of its successor. Pointer jumping from offset 0
of every file then marks the candidates on the chain of real records: each round doubles
the reach, so rounds grow with the logarithm of a file's records. Candidates off the chain
were payload bytes; they are given back to the record that holds them.

Offsets are sums of piece sizes inside a reader's block plus the sums of the blocks before, and
pieces find their record by (file, span of offsets): no archive is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..functions.staging import new_path, stage

#: Archives are cut here; a record goes on with its minor version and a line end.
MAGIC = "WARC/1."
MINOR = "^[01]\r\n"
END = "\r\n\r\n"
#: Pieces and the records that hold them meet by file and offset divided by this.
SPAN = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


# --- writing ---------------------------------------------------------------------


def _line(name: str, value: Column) -> Column:
    """A header line; null if the value is (concat_ws then leaves it out)."""
    return F.concat(F.lit(f"{name}: "), value)


def _urn(page: Column) -> Column:
    """A record's name by its key, percent-encoded; a missing key has a name of its own."""
    name = F.concat(F.lit("<urn:page:"), F.url_encode(page.cast("string")), F.lit(">"))
    return F.coalesce(name, F.lit("<urn:no-page:>"))


def _page(header: str) -> Column:
    """The key in a record's name, as text; null where the name holds none."""
    name = F.regexp_extract(_field(header), "<urn:page:[^>]*>", 0)
    return F.when(name != "", F.try_url_decode(F.substr(name, F.lit(11), F.length(name) - 11)))


def records(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """One column ``value``: the WARC record of each row, without its last line feed.

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest key
    is a response; others (null keys too, if any key is set) are revisits of it without a
    payload. Null payloads are empty. Rows that repeat the smallest key are all responses.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = df.select(
        F.col(key).alias("page"),
        F.translate(F.col(url), "\r\n", "").alias("uri"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    large = rows.where(F.col("size") >= least).select("digest", "page")
    groups = large.groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
    shared = stage(groups.where("n > 1").select(F.col("digest").alias("of"), "first"), "shared")
    joined = rows.join(shared, F.col("digest") == F.col("of"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Content-Type", F.when(~revisit, "text/html")),
        _line("Content-Length", F.octet_length(body).cast("string")),
    )
    return joined.select(F.concat(header, F.lit(END), body, F.lit("\r\n\r")).alias("value"))


def write(df: DataFrame, path: str, **columns) -> None:
    """Write plain WARC files, one or more per task. Each ends as the format asks: the text
    writer adds the last line feed of every record."""
    records(df, **columns).write.option("lineSep", "\n").text(path)


# --- reading ---------------------------------------------------------------------


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Archives cut at every version line: ``file, block, row, value``.

    ``row`` orders the pieces of a block of a file; the reader splits files freely.
    """
    cut = spark.read.option("lineSep", MAGIC).text(path)
    return cut.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )


def _field(name: str) -> Column:
    """Value of a header line; null without it."""
    found = F.regexp_extract(F.col("header"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def headers(cut: DataFrame) -> DataFrame:
    """``file, block, row, size`` and the header fields of every piece, real record or not.

    Fields are null where the piece has no readable header (a negative length isn't one).
    ``digest_read`` is that of the payload if the piece holds all of it.
    """
    opens = F.contains("value", F.lit(END)) & F.rlike("value", F.lit(MINOR))
    header = F.when(opens, F.substring_index("value", END, 1))
    opened = cut.select(
        "file", "block", "row", F.octet_length("value").cast("long").alias("size"), header.alias("header"),
        F.col("value").cast("binary").alias("raw"),
    )
    length = F.expr("try_cast(length_text as bigint)")
    parsed = opened.withColumn("length_text", _field("Content-Length")).select(
        "file", "block", "row", "size", "raw",
        F.when(length >= 0, length).alias("length"),
        (F.octet_length("header") + len(END)).cast("long").alias("head"),
        _field("WARC-Type").alias("type"),
        _page("WARC-Record-ID").alias("page"),
        _page("WARC-Refers-To").alias("refers"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "sha256:([0-9a-f]*)", 1).alias("digest"),
    )
    whole = F.col("size") >= F.col("head") + F.col("length")
    body = F.expr("substring(raw, cast(head + 1 as int), cast(length as int))")
    narrow = parsed.withColumn("digest_read", F.when(whole, F.sha2(body, 256)))
    return narrow.withColumn("mark", F.xxhash64("raw")).drop("raw")


def placed(cut: DataFrame) -> DataFrame:
    """Pieces with ``at``, the offset of their version line; what stands before a file's first goes.

    ``cut`` must be stored: it is read twice, and blocks and rows are those of one scan.
    """
    span, past = F.col("size") + len(MAGIC), (Window.unboundedPreceding, -1)
    blocks = cut.groupBy(F.col("file").alias("f"), F.col("block").alias("b")).agg(F.sum(span).alias("bytes"))
    over_file = Window.partitionBy("f").orderBy("b").rowsBetween(*past)
    first = F.coalesce(F.sum("bytes").over(over_file), F.lit(0)) - len(MAGIC)
    starts = stage(blocks.select("f", "b", first.alias("first")), "blocks")
    over_block = Window.partitionBy("file", "block").orderBy("row").rowsBetween(*past)
    inside = cut.withColumn("inside", F.coalesce(F.sum(span).over(over_block), F.lit(0)))
    joined = inside.join(starts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return joined.withColumn("at", F.col("first") + F.col("inside")).where("at >= 0").drop("f", "b", "first", "inside", "block", "row")


def candidates(cut: DataFrame) -> DataFrame:
    """``file, at, next`` and the header fields of every piece, real record or not.

    ``at`` is the offset of the version line, ``next`` the successor's offset by the
    header, null where the piece has no readable header.
    """
    found = placed(stage(headers(cut), "headers"))
    return found.withColumn("next", F.col("at") + len(MAGIC) + F.col("head") + F.col("length") + len(END))


def chain(found: DataFrame) -> DataFrame:
    """``file, at``: the candidates that the chain from offset 0 reaches."""
    spark = found.sparkSession
    now = found.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("real"))
    while True:
        jump = now.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("to").alias("beyond"))
        hit = now.where("real and to is not null").select(
            F.col("file").alias("g"), F.col("to").alias("b"), F.lit(True).alias("hit")
        )
        more = (
            now.join(hit, (F.col("file") == F.col("g")) & (F.col("at") == F.col("b")), "left")
            .join(jump, (F.col("file") == F.col("f")) & (F.col("to") == F.col("a")), "left")
            .select("file", "at", F.col("beyond").alias("to"), (F.col("real") | F.coalesce("hit", F.lit(False))).alias("real"))
        )
        going, path = Observation(), new_path(spark, "chain")
        more.observe(going, F.count_if(F.col("real") & F.col("to").isNotNull()).alias("n")).write.parquet(path)
        now = spark.read.schema(more.schema).parquet(path)
        if not going.get.get("n"):
            return now.where("real").select("file", "at")


def read(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """Real records: ``page_id`` (as ``kind``), ``payload_bytes, payload_digest,
    record_type, refers_to`` and ``intact`` (the payload's digest is the declared one).

    A revisit takes bytes and digest from the response it refers to. A last record that is
    cut off counts as a record that isn't intact.
    """
    found = stage(candidates(pieces(spark, path)), "candidates")
    on = chain(found).select(F.col("file").alias("f"), F.col("at").alias("a"))
    real = stage(found.join(on, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a"))).drop("f", "a"), "records")
    own = real.select(
        F.expr(f"try_cast(page as {kind})").alias("page_id"),
        F.expr(f"try_cast(refers as {kind})").alias("refers_to"),
        F.col("type").alias("record_type"), "length", "digest", "digest_read", "file", "at", "next", "head",
    )
    columns = ["page_id", "refers_to", "record_type", "length", "digest", "digest_read"]
    broken = own.where("digest_read is null")
    if broken.isEmpty():
        full = own.select(columns)
    else:
        mended = stage(rejoined(spark, path, found, broken), "mended")
        full = own.join(mended, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")), "left")
        full = full.join(lengths(found), F.col("file") == F.col("g"))
        full = full.withColumn("digest_read", F.coalesce("digest_read", "digest_mended", lost()))
        full = stage(full.select(columns), "read")
    answers = stage(
        full.where("record_type = 'response'").groupBy(F.col("page_id").alias("p"))
        .agg(F.min(F.struct("length", "digest_read")).alias("response")),
        "responses",
    )
    seen = full.join(answers, (F.col("record_type") == "revisit") & (F.col("refers_to") == F.col("p")), "left")
    revisit = F.col("record_type") == "revisit"
    digest = F.when(revisit, F.col("response.digest_read")).otherwise(F.col("digest_read"))
    return seen.select(
        "page_id",
        F.when(revisit, F.col("response.length")).otherwise(F.col("length")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        "refers_to",
        F.coalesce(digest == F.col("digest"), F.lit(False)).alias("intact"),
    )


def lengths(found: DataFrame) -> DataFrame:
    """``g, bytes``: up to where each file was cut; a closing version line may be left out."""
    return found.groupBy(F.col("file").alias("g")).agg(F.max(F.col("at") + len(MAGIC) + F.col("size")).alias("bytes"))


def lost() -> Column:
    """An error where a payload that the file held wasn't found again; null for one cut off."""
    end = F.col("at") + len(MAGIC) + F.col("head") + F.col("length")
    told = F.concat(F.lit("archive was changed between two scans: "), F.col("file"), F.lit(" at "), F.col("at"))
    return F.when(end <= F.col("bytes"), F.raise_error(told).cast("string"))


def held_pieces(found: DataFrame, broken: DataFrame) -> DataFrame:
    """``f, a, mark, record, head, length``: the pieces of records that version lines cut up.

    A record is dealt to every span of offsets that it covers, up to the end of its file.
    """
    starts = broken.where("next is not null").join(lengths(found), F.col("file") == F.col("g"))
    last = F.least("next", "bytes") - 1
    covers = F.explode(F.sequence(F.expr(f"at div {SPAN}"), F.floor(last / SPAN)))
    starts = starts.select(F.col("file").alias("f"), F.col("at").alias("record"), "next", "head", "length", covers.alias("span"))
    cut = found.select("file", F.col("at").alias("a"), "mark")
    here = (F.col("file") == F.col("f")) & (F.expr(f"a div {SPAN}") == F.col("span"))
    inside = (F.col("a") >= F.col("record")) & (F.col("a") < F.col("next"))
    return cut.join(starts, here & inside).select("f", "a", "mark", "record", "head", "length")


def rejoined(spark: SparkSession, path: str, found: DataFrame, broken: DataFrame) -> DataFrame:
    """``f, a, digest_mended`` of records whose payload holds version lines.

    Files that hold such records are read again, and the bytes of their pieces are stored
    beside the sizes of all others. Offsets come from that table alone, so it doesn't matter
    how either scan was split. A group is one record's pieces.
    """
    held = stage(held_pieces(found, broken), "held")
    wanted = held.select(F.col("f").alias("g"), F.col("mark").alias("m")).distinct()
    raw = F.col("value").cast("binary")
    again = pieces(spark, path).join(held.select("f").distinct(), F.col("file") == F.col("f"), "left_semi").select(
        "file", "block", "row", F.octet_length("value").cast("long").alias("size"), raw.alias("raw"), F.xxhash64(raw).alias("mark")
    )
    again = again.join(wanted, (F.col("file") == F.col("g")) & (F.col("mark") == F.col("m")), "left")
    again = stage(again.select("file", "block", "row", "size", F.when(F.col("m").isNotNull(), F.col("raw")).alias("raw")), "again")
    same = (F.col("file") == F.col("f")) & (F.col("at") == F.col("a"))
    grouped = placed(again).where("raw is not null").join(held, same).groupBy("f", "record").agg(
        F.first("head").alias("head"), F.first("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("parts"),
    )
    whole = F.aggregate(
        "parts",
        F.lit(b""),
        lambda all_, part: F.when(F.octet_length(all_) == 0, part["raw"]).otherwise(
            F.concat(all_, F.lit(MAGIC.encode()), part["raw"])
        ),
    )
    body = F.expr("substring(whole, cast(head + 1 as int), cast(length as int))")
    grouped = grouped.withColumn("whole", whole).withColumn("body", body)
    complete = F.octet_length("body") == F.col("length")
    return grouped.select("f", F.col("record").alias("a"), F.when(complete, F.sha2("body", 256)).alias("digest_mended"))


def round_trip(df: DataFrame, **columns) -> DataFrame:
    """Write the archives to a new path in the shared folder and read them back."""
    path = new_path(df.sparkSession, "warc")
    write(df, path, **columns)
    return read(df.sparkSession, path, df.schema[columns.get("key", "page_id")].dataType.simpleString())
