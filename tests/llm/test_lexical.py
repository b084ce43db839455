"""Ranked search against the formula over all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import lexical
from bazaarline.llm.queries import QUERIES
from odd import SMALL, no_docs, odd_docs

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def slow(docs, items, k=50):
    held = [(key, Counter(terms(t))) for key, t in docs]
    held = [(key, c, sum(c.values())) for key, c in held if c]
    n, total = len(held), sum(s for _, _, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c, size in held:
            m = 50 + (50 * size * n) // total
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, key is None, key))
        best = sorted(scores)[:k]
        out += [(item, rank, key, -s) for rank, (s, _, key) in enumerate(best, 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    made = QUERIES["op11_lexical_search"](spark, SMALL)
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(made) == slow(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))


@pytest.mark.parametrize("options", [{"shard_docs": 7, "block": 2}, {"set_bytes": 300, "block": 3}, {"shard_terms": 50}])
def test_shards_blocks_and_sets_change_nothing(spark, options):
    rng = np.random.default_rng(1)
    text = lambda n: " ".join(f"t{int(v)}" for v in rng.zipf(1.3, n) % 60)
    docs = [(i, text(int(rng.integers(0, 40)))) for i in range(150)]
    docs += [(i + 150, docs[i % 10][1]) for i in range(60)]  # ties
    items = [(i, text(int(rng.integers(0, 12)))) for i in range(25)]
    made = lexical.top_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        k=8,
        **options,
    )
    assert rows(made) == slow(docs, items, 8)


def test_blocks_are_skipped(spark):
    """On clustered documents most are never scored, and the best are right all the same."""
    rng = np.random.default_rng(2)
    topics = [[f"k{j}_{i}" for i in range(30)] for j in range(40)]
    docs = [" ".join([*rng.choice(topics[i % 40], 12), *rng.choice(["the", "of", "and", "to"], 20)]) for i in range(4000)]
    queries = lexical.Queries()
    for j in range(20):
        queries.add(j, " ".join([*topics[j][:5], "the", "of"]))
    vocabulary = queries.vocabulary
    frame = spark.createDataFrame(list(enumerate(docs)), "doc long, text string").coalesce(1)
    held = lexical.forward(frame, vocabulary)
    weights = lexical.weigh(held, len(vocabulary))
    rows = held.orderBy("doc").collect()
    arrays = lexical.Builder(weights, 64).build([r.n for r in rows], [bytes(r.ids) for r in rows], [bytes(r.tfs) for r in rows])
    shard = lexical.Shard(arrays, len(vocabulary))
    number = dict(zip(vocabulary, weights.number))
    for own in queries.terms:
        asked = sorted(number[t] for t in own)
        shard.search(asked, [weights.weight[t] for t in asked], 50, 0)
    assert shard.scored < 0.1 * 20 * 4000


def test_odd_rows(spark, odd_docs, no_docs):
    items = odd_docs.select(F.col("doc_id").alias("item_id"), "text", F.lit(1).alias("rank"))
    want = slow(pairs(odd_docs, "doc_id", "text"), pairs(items, "item_id", "text"), 5)
    assert rows(lexical.top_documents(odd_docs, items, k=5)) == want
    assert rows(lexical.top_documents(no_docs, items)) == []
    assert rows(lexical.top_documents(odd_docs, items.where("false"))) == []
    names = odd_docs.withColumn("doc_id", F.concat(F.lit("n"), "doc_id"))
    made = lexical.top_documents(names, items.where("item_id = 5"))
    assert [r.doc_id for r in made.orderBy("rank").collect()][:3] == ["n5", "n6", None]
