"""Encoding, counts, packing and files against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarline.llm import bpe, counts, packing, token_files
from bazaarline.llm.queries import BYTE, BYTE_RANKS, QUERIES, WORD
from odd import SMALL, no_docs, odd_docs

LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def by_library(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids):
    return list(struct.unpack(f"<{len(ids) // 4}I", ids))


def fuzz(n):
    rng = random.Random(5)
    parts = [chr(i) for i in range(0x180)] + ["  ", " \n", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", " the", "Σ", "́", "漢", "😀", "ǅ", "٣", " "] * 6
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_the_library(path):
    own = bpe.encoder(path)
    for text in [*fuzz(1500), "a" * 3000, "ab" * 2000, " " * 500, "\n \n x"]:
        ids = by_library(path, text)
        assert own.encode(text) == packed(ids), repr(text)
        assert own.decode(packed(ids)) == LIBRARY[path].decode(ids, skip_special_tokens=False)


def test_rank_file_gives_the_same_ids():
    own = bpe.ranked(BYTE, BYTE_RANKS)
    for text in [*fuzz(1500), "a" * 3000, " " * 500]:
        assert own.encode(text) == packed(by_library(BYTE, text)), repr(text)


def test_memo_stays_bounded_and_right():
    memo = bpe.Memo(len, bound=3, fixed={"": 0})
    for text in ["a", "bb", "ccc", "dddd", "a", "eeeee", "bb", "", "ffffff"] * 3:
        assert memo[text] == len(text)
        assert len(memo) + len(memo.old) <= 9


def test_plain_range_is_its_own_normal_form():
    import unicodedata

    assert all(unicodedata.is_normalized("NFC", chr(i)) for i in range(0x180) if bpe.PLAIN(chr(i)))


def test_whole_tokens_are_proven():
    proven = counts.whole_tokens(BYTE)
    assert len(proven) > 40_000
    assert all(len(by_library(BYTE, p)) == 1 for p in random.Random(1).sample(proven, 2000))


def test_odd_documents(odd_docs):
    made = odd_docs.select("doc_id", "text", bpe.encode("text", WORD).alias("w")).withColumn("back", bpe.decode("w", WORD))
    for row in made.collect():
        ids = by_library(WORD, row.text)
        assert unpacked(row.w) == ids
        assert row.back == LIBRARY[WORD].decode(ids, skip_special_tokens=False)
    whole = bpe.coded(odd_docs, WORD)
    assert whole.columns == [c for c in odd_docs.columns if c != "ids"] + ["ids", "decoded"]
    pairs = lambda rows: sorted((str(r.doc_id), bytes(r.w), r.back) for r in rows)
    again = whole.select("doc_id", "ids", "decoded").toDF("doc_id", "w", "back").collect()
    assert pairs(again) == pairs(made.collect())
    for row in counts.with_counts(odd_docs.withColumn("n_tokens", F.lit("x")), BYTE).collect():
        n = len(by_library(BYTE, row.text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((row.text or "").encode()), n, n > 512)


def test_empty_tables(no_docs):
    assert no_docs.select(bpe.encode("text", WORD).alias("w")).select(bpe.decode("w", WORD)).count() == 0
    assert counts.with_counts(no_docs, BYTE).count() == 0
    assert packing.pack(no_docs, BYTE, BYTE_RANKS).count() == 0
    assert token_files.round_trip(no_docs, BYTE, BYTE_RANKS).count() == 0


def check_packed(pieces, texts, tiers, key="doc_id"):
    """Every id in one piece, windows gapless and within their tier."""
    windows, documents, padding = {}, {}, 0
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append(p)
        documents.setdefault(p[key], []).append(p)
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        used = sum(p.length for p in own)
        assert used <= own[0].tier and len({(p.tier, p.step_group) for p in own}) == 1
        padding += 0 if used & (used - 1) == 0 else max(tiers) - used
    for doc, text in texts.items():
        ids = [*by_library(BYTE, text), 0]
        own = sorted(documents.pop(doc), key=lambda p: p.start)
        assert [i for p in own for i in unpacked(p.ids)] == ids
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert all(p.doc_tokens == len(ids) and p.length == len(p.ids) // 4 for p in own)
    assert not documents
    return padding


@pytest.mark.parametrize("block", [1 << 19, 900])
def test_packing_keeps_every_id(spark, block):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    pieces = packing.pack(docs, BYTE, BYTE_RANKS, block_tokens=block).collect()
    padding = check_packed(pieces, {r.doc_id: r.text for r in docs.collect()}, (1024,))
    assert padding <= 1024


def test_packing_odd_documents(odd_docs):
    from collections import Counter

    texts = odd_docs.select("doc_id", "text").collect()
    pieces = packing.pack(odd_docs, BYTE, BYTE_RANKS, tiers=(64, 16, 4), block_tokens=300).collect()
    assert sum(p.length for p in pieces) == sum(len(by_library(BYTE, r.text)) + 1 for r in texts)
    starts = Counter(p.doc_id for p in pieces if p.start == 0)
    assert starts == Counter(r.doc_id for r in texts)
    used = Counter()
    for p in pieces:
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 64
    with pytest.raises(ValueError):
        packing.pack(odd_docs, BYTE, BYTE_RANKS, tiers=(100,))


def test_step_groups_are_balanced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = packing.pack(docs, BYTE, BYTE_RANKS).where("tier = 1024")
    groups = pieces.groupBy("step_group").agg(F.sum("length").alias("n"), F.sum(F.col("length") ** 2).alias("cost")).collect()
    assert len(groups) > 5
    mean = sum(g.cost for g in groups) / len(groups)
    assert all(abs(g.cost - mean) < 0.2 * mean for g in groups)


def test_perfect_hash_is_minimal():
    for n in (1, 2, 3, 50, 3000):
        keys = [token_files.key_bytes(i * 7) for i in range(n)]
        made = token_files.PerfectHash.build(keys)
        assert sorted(made.slot(k) for k in keys) == list(range(n))


def test_files_hold_the_documents_in_order(odd_docs, spark, tmp_path):
    path = str(tmp_path / "shards")
    token_files.write(odd_docs, path, BYTE, BYTE_RANKS, shard_ids=2000, shard_docs=4)
    rows = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd_docs.collect()), key=lambda k: (k is not None, k))
    at, by_id = 0, {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    for r in rows:
        ids = [*by_library(BYTE, by_id.get(r.doc_id, odd_docs.where("doc_id = 5").first().text)), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)


def test_keyed_access(odd_docs, spark, tmp_path):
    path = str(tmp_path / "shards")
    token_files.write(odd_docs, path, BYTE, BYTE_RANKS, shard_docs=3)
    rows = token_files.lookup(spark, path, [3, 7, 10, 999, -1]).collect()
    assert sorted(r.doc_id for r in rows) == [3, 3, 3, 7, 10]
    for r in rows:
        assert unpacked(r.ids) == [*by_library(BYTE, odd_docs.where(f"doc_id = {r.doc_id}").first().text), 2]
    assert token_files.lookup(spark, path, []).count() == 0
    with pytest.raises(ValueError):
        token_files.lookup(spark, path, range(20), most=10)


def test_queries(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe"](spark, SMALL).collect():
        ids = by_library(WORD, docs[r.doc_id])
        back = LIBRARY[WORD].decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    made = QUERIES["op6_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in made} == {i: len(by_library(BYTE, t)) for i, t in docs.items()}
    start = 0
    for r in sorted(QUERIES["op5_token_files"](spark, SMALL).collect(), key=lambda r: r.doc_id):
        ids = [*by_library(BYTE, docs[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    for r in QUERIES["op3_packing"](spark, SMALL).collect():
        ids = [*by_library(BYTE, docs[r.doc_id]), 0][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(packed(ids)) and len(ids) == r.length


def test_keys_that_look_alike(spark, tmp_path):
    """A missing key, an empty text, both zeros and every NaN: each key has one run of documents."""
    for number, (kind, keys) in enumerate([
        ("string", [None, "", "", "\xff", "#", None, "5"]),
        ("double", [float("nan"), 0.0, -0.0, float("nan"), None, 2.5, -0.0]),
    ]):
        docs = spark.createDataFrame([(k, f"text {i}") for i, k in enumerate(keys)], f"doc_id {kind}, text string")
        path = str(tmp_path / str(number))
        token_files.write(docs, path, BYTE, BYTE_RANKS)
        rows = token_files.read(spark, path).collect()
        assert sorted(repr(r.doc_id).replace("-0.0", "0.0") for r in rows) == sorted(repr(k).replace("-0.0", "0.0") for k in keys)
    made = token_files.index_of([None, "", "a", "a"])
    assert sorted(memoryview(made["count"]).cast("I")) == [1, 1, 2]
    made = token_files.index_of([float("nan")] * 3)
    assert list(memoryview(made["count"]).cast("I")) == [3]
    with pytest.raises(ValueError, match="distinct"):
        token_files.PerfectHash.build([b"a", b"b", b"a"])


def test_memory_of_words_is_bounded():
    """Words of any length leave a bounded memo, and ids are the library's."""
    own, random_ = bpe.Bpe(BYTE), random.Random(5)
    memo = own.pretokens
    memo.letters, memo.bound = 5000, 400
    own.chunks.letters, own.chunks.bound = 5000, 400
    for size in (1, 30, 200, 256, 257, 3000):
        for _ in range(60):
            text = " ".join("".join(random_.choices("abcXYZ", k=size)) for _ in range(3))
            assert unpacked(own.encode(text)) == by_library(BYTE, text)
            for m in (memo, own.chunks):
                assert max(map(len, [*m, *m.old]), default=0) <= 256 and len(m) <= 400 and sum(map(len, m)) <= 5256


def test_long_texts_are_cut_in_linear_time(spark, monkeypatch):
    """A document of 100 MB of ids: the rest isn't copied for every window."""
    ids = packed(list(range(25_000)) * 1000)

    class Coder:
        def encode(self, text):
            return ids

    import time

    import pyarrow as pa

    monkeypatch.setattr(packing, "ranked", lambda path, ranks: Coder())
    monkeypatch.setattr(packing, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)}))}))
    got = {}

    class Frame:
        columns = ["doc_id", "text"]
        schema = spark.createDataFrame([], "doc_id long, text string").schema

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["x"])], ["doc_id", "text"])
            start = time.time()
            got["lengths"] = [n for out in run([batch]) for n in out.column("length").to_pylist()]
            got["seconds"] = time.time() - start

    packing.pack(Frame(), BYTE, BYTE_RANKS)
    assert sum(got["lengths"]) == 25_000_001 and got["seconds"] < 20
