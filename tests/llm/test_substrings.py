"""Substring dedup against brute force over all windows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarline.llm import substrings
from bazaarline.llm.queries import QUERIES
from odd import SMALL, no_docs, odd_docs


def slow(rows, window=50):
    """``(key, n_words, n_removed, kept)`` of ``(key, text)`` rows, by the definition."""
    split = [(k, (t or "").encode().split()) for k, t in rows]
    least = {}
    for k, words in split:
        for i in range(len(words) - window + 1) if k is not None else ():
            w = tuple(words[i : i + window])
            least[w] = min(k, least.get(w, k))
    out = []
    for k, words in split:
        gone = set()
        for i in range(len(words) - window + 1) if k is not None else ():
            if least[tuple(words[i : i + window])] < k:
                gone |= set(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        out.append((k, len(words), len(gone), kept))
    return sorted(out, key=repr)


def fast(docs, window=50):
    made = substrings.without_repeats(docs, window=window).collect()
    for r in made:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(s.end - s.start >= window for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in made), key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = QUERIES["op12_substring_dedup"](spark, SMALL).collect()
    wanted = slow([(r.doc_id, r.text) for r in docs.collect()])
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(tuple(r) for r in made) == sorted((k, n, g, digest(t)) for k, n, g, t in wanted)
    assert sum(r.n_removed > 0 for r in made) > 3


def test_overlapping_shifted_and_mosaic_repeats(spark):
    """Passages at every shift, repeats within a document, and parts of several documents."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 40, 400)]
    rows = [(5, base[:200]), (9, base[13:75]), (12, ["x"] * 7 + base[60:131] + ["y"] * 3 + base[0:50])]
    rows += [(20 + s, ["z"] * s + base[s : s + 50 + s % 3] + [f"q{s}"]) for s in range(60)]
    rows += [(3, base[300:349]), (100, base[300:349]), (101, base[290:341]), (102, base[290:340])]
    rows += [(200, ["r"] * 120), (201, ["r"] * 49 + ["s"]), (202, ["s"] + ["r"] * 51), (1, base[100:150] * 3)]
    rows = [(k, "  ".join(w)) for k, w in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert fast(docs) == slow(rows)
    assert fast(docs, 7) == slow(rows, 7)
    assert fast(docs, 2) == slow(rows, 2)


def test_a_passage_that_all_documents_share(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"a{i} {passage} b{i % 7}") for i in range(3000, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    made = fast(docs)
    assert made == slow(rows) and (1, 57, 0, rows[-1][1]) in made
    assert sum(g >= 55 for _, _, g, _ in made) == 2999


def test_odd_rows(odd_docs, no_docs, spark):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert fast(odd_docs) == slow(rows)
    assert fast(no_docs) == []
    with pytest.raises(ValueError):
        substrings.without_repeats(odd_docs.withColumn("doc_id", F.lit("a")))
    same = spark.createDataFrame([(4, "v " * 60), (4, "v " * 70), (None, "v " * 80), (7, "v " * 50)], "doc_id int, text string")
    assert {r[1:3] for r in fast(same)} == {(60, 0), (70, 0), (80, 0), (50, 50)}


def test_long_words_and_many_buckets():
    words = [b"a" * 5000, b"b", b"a" * 4095, b"a" * 4096] + [b"c%d" % i for i in range(100)]
    one = substrings.word_hashes(words)
    assert (one == substrings.word_hashes(words, 3)).all() and len(set(one.tolist())) == len(words)
    h = substrings.rolled(one, 25)
    assert len(h) == len(words) - 24 and (h[5:] == substrings.rolled(one[5:], 25)).all()
    assert len(substrings.rolled(one[:10], 25)) == 0
