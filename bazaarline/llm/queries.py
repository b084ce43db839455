"""One query per operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, bpe, counts, fingerprints, lexical, packing, quality, secret_ledger, simhash, substrings, token_files, topk, warc

BYTE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = public_tokenizers.path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_and_next(read(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.coded(read(spark, sf_dir, "documents"), WORD, keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), BYTE, BYTE_RANKS)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    held_out = F.coalesce(quality.fold() == 1, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.score(model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), BYTE, BYTE_RANKS)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = counts.with_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), BYTE)
    return docs.drop("text")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op8_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").where(topk.usable("embedding"))
    rows = rows.select("vec_id", topk.quantised("embedding").alias("vector"))
    return topk.top_k(rows, F.col("vec_id") % 50 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.findings(read(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_ledger.BASE]
    amount = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(amount(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_ledger.listed("findings", base), 256).alias("base_sha256"),
        secret_ledger.listed("findings", [r.kind for r in secret_ledger.RULES]).alias("spans"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substrings.without_repeats(read(spark, sf_dir, "documents"), as_text=False)
    return made.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = alignment.aligned(read(spark, sf_dir, "documents"), BYTE_RANKS, PIECES, as_text=False)
    return made.withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_bpe": op2_bpe,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_token_files": op5_token_files,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_pivot_topk": op8_pivot_topk,
    "op9_simhash": op9_simhash,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_lexical_search": op11_lexical_search,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_alignment": op13_alignment,
}


def _secret_sql() -> str:
    """Spans from the lengths of gaps and matches, written out by kind."""
    assign = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [
        ("assign", assign, 8),
        ("access", "AKIA[A-Z0-9]+", 16),
        ("hex", "[0-9a-f]+", 32),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 1),
        ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 1),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1),
    ]
    parts = []
    for order, (kind, pattern, least) in enumerate(kinds):
        p = pattern.replace("'", "''")
        # short runs of hexadecimal letters are in every word: keep to texts with a long one
        where = "WHERE regexp_matches(t, '[0-9a-f]{32}')" if kind == "hex" else f"WHERE regexp_matches(t, '{p}')"
        parts.append(
            f"""SELECT doc_id, {order} AS o, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, g, m, v, {least} AS least
            FROM (SELECT doc_id, list_transform(regexp_split_to_array(t, '{p}'), lambda x: length(x)) AS g,
                         list_transform(regexp_extract_all(t, '{p}'), lambda x: length(x)) AS m,
                         list_transform(regexp_extract_all(t, '{p}', {1 if kind == "assign" else 0}), lambda x: length(x)) AS v
                  FROM d {where})"""
        )
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        hits AS ({" UNION ALL ".join(parts)}),
        found AS (
            SELECT doc_id, o, kind, coalesce(list_sum(g[1:i]), 0) + coalesce(list_sum(m[1:i - 1]), 0) AS s, m[i] AS n
            FROM hits WHERE v[i] >= least),
        named AS (SELECT *, kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS span FROM found)
        SELECT d.doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
               count(*) FILTER (o = 2) AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY s, o) FILTER (o < 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY s, o), '') AS spans
        FROM d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id"""


WARC_SQL = """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest
               FROM pages),
    f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM p)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to,
           true AS intact
    FROM f"""

TOPK_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
        FROM v AS q JOIN v AS x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
    FROM s QUALIFY rank <= 5"""

LEXICAL_SQL = """
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-z0-9\\x{80}-\\x{10ffff}]+')) AS term FROM documents),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[a-z0-9\\x{80}-\\x{10ffff}]+')) AS term FROM benchmark),
    lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY 1),
    corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
    postings AS (
        SELECT doc_id, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
        FROM postings, corpus GROUP BY term),
    impacts AS (
        SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)) AS c
        FROM postings JOIN lengths USING (doc_id), corpus),
    scores AS (
        SELECT item_id, doc_id, sum(w * c)::BIGINT AS score
        FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY 1, 2)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 50"""

SQL = {"op11_lexical_search": LEXICAL_SQL, "op7_warc": WARC_SQL, "op8_pivot_topk": TOPK_SQL, "op10_secret_ledger": _secret_sql()}
