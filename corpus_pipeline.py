"""Clean a corpus and pack it for training.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and read again as the next stage's documents. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarline.functions.staging import new_path, scratch
from bazaarline.llm import packing, quality, secret_ledger, simhash
from bazaarline.llm.queries import BYTE, BYTE_RANKS, read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at 0.5 or more; the rest goes."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, "text") >= 0.5).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Near duplicates have SimHash fingerprints of three-word shingles that differ in at most
    three bits, or are linked by others that do.
    """
    return simhash.deduplicated(docs, most=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the characters of every secret overwritten."""
    return secret_ledger.mask(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows of all documents that are left."""
    return packing.pack(docs, BYTE, BYTE_RANKS)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("secrets", mask_secrets),
    ("packing", pack_documents),
]
#: Tokenizers, trained weights and fingerprints aren't SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage staged on its way goes once its rows are written."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = new_path(spark, name)
        with scratch(spark):
            made = function(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
