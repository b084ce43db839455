"""The classifier: gradients, held-out accuracy, odd inputs; and the whole pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarline.functions import staging
from bazaarline.llm import quality
from bazaarline.llm.queries import BYTE, QUERIES
from odd import SMALL, no_docs, odd_docs
from test_duplicates import slow_groups, slow_simhash
from test_scans import slow_base
from test_tokens import by_library, unpacked

SMALLER = "/root/testdata/sf0.01"


def loss(model, x, starts, y):
    p = model.forward(x, starts)["p"]
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    return -(share * np.where(y == 1, np.log(p), np.log(1 - p))).sum()


def test_training_follows_the_gradient():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(30, quality.FEATURES)), np.array([0, 4, 5, 12, 20]), np.array([0.0, 1, 1, 0, 1])
    before = quality.train(x, starts, y, steps=0)
    step = quality.train(x, starts, y, steps=1, rate=1e-6, decay=0)
    for name in "WbVUacd":
        moved = step.weights[name] - quality.train(x, starts, y, steps=0).weights[name]
        at = np.unravel_index(np.abs(moved).argmax(), moved.shape)
        up, down = (quality.train(x, starts, y, steps=0) for _ in range(2))
        up.weights[name][at] += 1e-5
        down.weights[name][at] -= 1e-5
        slope = (loss(up, x, starts, y) - loss(down, x, starts, y)) / 2e-5
        assert np.sign(moved[at]) == -np.sign(slope), name
    assert loss(quality.train(x, starts, y, steps=200), x, starts, y) < 0.3 * loss(before, x, starts, y)


def test_attention_finds_the_passage_that_matters():
    """One odd passage among many plain ones makes the label."""
    rng = np.random.default_rng(1)
    parts, y = [], []
    for i in range(200):
        part = rng.normal(0, 0.3, (rng.integers(3, 12), quality.FEATURES))
        if i % 2:
            part[rng.integers(len(part)), 0] += 4
        parts.append(part)
        y.append(float(i % 2))
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    x, y = np.concatenate(parts), np.array(y)
    model = quality.train(x, starts, y)
    made = model.forward(x, starts)
    assert ((made["p"] >= 0.5) == y).mean() > 0.95
    heaviest = [made["attention"][a : a + len(p)].argmax() for a, p in zip(starts, parts)]
    assert np.mean([h == p[:, 0].argmax() for h, p, label in zip(heaviest, parts, y) if label]) > 0.9


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALLER}/labels.parquet").collect()}
    rows = QUERIES["op4_quality"](spark, SMALLER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 80 and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_scores_come_from_the_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.fit(docs, labels)
    other = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.fit(docs.repartition(5), other)
    texts = [r.text for r in docs.collect()]
    assert np.allclose(model.scores(texts), again.scores(texts))
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts])


def test_odd_documents_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (2, 0), (3, 1), (None, 1), (9, None), (999, 0), (5, 7)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels)
    rows = odd_docs.select("doc_id", quality.score(model, "text").alias("s")).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.s <= 1 for r in rows)
    one_class = quality.fit(odd_docs, labels.where("quality = 1"))
    assert one_class.weights is None and 0.5 < one_class.prior < 1
    assert quality.fit(no_docs, labels).prior == 0.5 == quality.fit(odd_docs, labels.where("false")).prior
    assert no_docs.select(quality.score(model, "text")).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    from bazaarline.functions.staging import stage

    tables = [spark.read.parquet(f"{SMALLER}/documents.parquet")]
    for name, function in corpus_pipeline.STAGES:
        tables.append(stage(function(spark, tables[-1], SMALLER), name))
    return [t.collect() for t in tables]


def test_pipeline_stages_against_brute_force(spark, stages):
    docs, good, distinct, masked, pieces = stages
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALLER}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    known = [r.doc_id for r in docs if r.doc_id in labels]
    assert np.mean([(i in kept) == bool(labels[i]) for i in known]) > 0.97
    good = sorted(good, key=lambda r: r.doc_id)
    roots = slow_groups([slow_simhash(r.text) for r in good])
    assert {r.doc_id for r in distinct} == {good[i].doc_id for i in roots}
    before = {r.doc_id: r.text for r in distinct}
    assert {r.doc_id for r in masked} == set(before)
    for r in masked:
        expected = list(before[r.doc_id])
        for span in filter(None, slow_base(before[r.doc_id]).split(",")):
            _, a, b = span.split(":")
            expected[int(a) : int(b)] = "*" * (int(b) - int(a))
        assert r.text == "".join(expected)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p.start):
        by_doc.setdefault(p.doc_id, []).extend(unpacked(p.ids))
    assert by_doc == {r.doc_id: [*by_library(BYTE, r.text), 0] for r in masked}


def test_pipeline_takes_odd_and_empty_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        rows = docs
        for name, function in corpus_pipeline.STAGES:
            made = function(spark, rows, SMALL)
            assert name == "packing" or made.columns == docs.columns
            rows = made
        assert (rows.count() > 0) == (docs is odd_docs)


def test_run(spark):
    made = corpus_pipeline.run(spark, SMALL)
    assert made.count() > 100 and {"doc_id", "ids", "sequence_id", "offset"} <= set(made.columns)


def test_pipeline_leaves_only_its_stages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "work_dir", lambda _: staging._scratch.get() or str(tmp_path))
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == sorted(name for name, _ in corpus_pipeline.STAGES)
