"""Cross-tokenizer alignment against the libraries and plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarline.llm import alignment
from bazaarline.llm.bpe import byte_letters
from bazaarline.llm.queries import BYTE, BYTE_RANKS, PIECES, QUERIES
from odd import SMALL, no_docs, odd_docs
from test_tokens import fuzz

A = Tokenizer.from_file(BYTE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
BACK = {letter: byte for byte, letter in enumerate(byte_letters())}


def tokens(text):
    """``(id, bytes)`` of both libraries, or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(BACK[c] for c in A.id_to_token(i))) for i in a]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def slow(texts):
    """Figures of each text by byte ranges, all pairs of tokens near each other."""
    held, counts = [], Counter()
    for text in texts:
        both = tokens(text)
        if both is None:
            held.append(None)
            continue
        spans = []
        for side in both:
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(i, e - len(t), e) for (i, t), e in zip(side, ends)])
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, links, start = [], [], 0
        for end in ends:
            a, b = ([s for s in side if start <= s[1] and s[2] <= end] for side in spans)
            spans = [[s for s in side if s[1] >= end] if len(side) < 400 else side[len(g) :] for side, g in zip(spans, (a, b))]
            groups.append(",".join(str(i) for i, _, _ in a) + "|" + ",".join(str(i) for i, _, _ in b))
            links += [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
            start = end
        counts.update(links)
        held.append((len(both[0]), len(both[1]), groups, links))
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(n, top.get(j, 0))
    out = []
    for h in held:
        if h is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = h
            best = sum(counts[x] == top[x[1]] for x in links)
            out.append((n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), ";".join(groups)))
    return out


def test_query_against_the_libraries(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    made = {r.doc_id: r for r in QUERIES["op13_alignment"](spark, SMALL).collect()}
    want = slow([r.text for r in docs])
    for r, w in zip(docs, want):
        digest = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert tuple(made[r.doc_id])[1:] == (*w[:6], digest)
    assert len(made) == len(docs)


SPECIAL = ["<unk> <s> </s> <0x41>", "▁ x▁y", "<|endoftext|> a", "a　b  c", "tab\t x", " lead", "trail ", "a  b", "\x00 z", "ﬁ ½ Å", "漢字 かな", "á ́b"]


@pytest.mark.parametrize("part_pairs", [1 << 21, 400])
def test_odd_texts_in_one_part_and_in_many(spark, part_pairs):
    texts = [*SPECIAL, *fuzz(400), "y" * 3000, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = alignment.aligned(docs, BYTE_RANKS, PIECES, part_pairs=part_pairs).orderBy("doc_id").collect()
    for r, want, text in zip(made, slow(texts), texts):
        assert tuple(r)[1:] == want, repr(text)


def test_runs_equal_the_whole_text():
    own = alignment.aligner(BYTE_RANKS, PIECES)
    rng = random.Random(3)
    words = [w for t in fuzz(600) for w in t.split()] + ["don't", "WE'LL", "x1", "'s", "...", "ﬁn", "漢"]
    for _ in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(1, 12)))
        parts, whole = own.align(own.runs(text)), own.align([text])
        assert parts.good.all() == whole.good.all(), repr(text)
        if whole.good.all():
            assert ";".join(parts.groups) == whole.groups[0], repr(text)
            assert parts.pairs.tolist() == whole.pairs.tolist() and parts.ends[-1] == len(parts.pairs)
    assert own.by_run and len(own.runs("a b")) == 2 and len(own.runs("a  b")) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 200_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 50, n, dtype="u8"))
    for slots in (alignment.Slots.build(keys), alignment.Slots.build(keys, most=1)):
        again = alignment.Slots.opened(slots.stored())
        assert sorted(again.find(keys).tolist()) == list(range(len(keys)))
        others = again.find(keys + np.uint64(1 << 51))
        assert ((others >= -1) & (others < max(len(keys), 1))).all()
    with pytest.raises(ValueError):
        alignment.Slots.build(np.array([3, 3], "u8"))


def test_memory_of_runs_is_bounded():
    memo = alignment.Remembered(alignment.aligner(BYTE_RANKS, PIECES), bound=20_000)
    for i in range(500):
        assert memo.of([f"run{i} again", None, "z" * 100 + " q"])[1] == []
        assert "z" * 100 not in memo.numbers and len(memo.numbers) < 100
        if memo.full:
            memo.clear()
    parts = list(alignment.slices(alignment.pa.array(["a" * 9, None, "b", "c" * 30, "d"]), 10))
    assert [len(p) for p in parts] == [3, 1, 1]


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    made = alignment.aligned(odd_docs, BYTE_RANKS, PIECES).collect()
    want = [(r.doc_id, *w) for r, w in zip(rows, slow([r.text for r in rows]))]
    assert sorted(map(tuple, made), key=repr) == sorted(want, key=repr)
    assert alignment.aligned(no_docs, BYTE_RANKS, PIECES).collect() == []
    assert alignment.aligned(odd_docs.where("text is null"), BYTE_RANKS, PIECES).first().n_a == 0


def test_the_count_of_pairs_writes_no_groups():
    """The first pass needs links alone; figures and pairs are those of the second."""
    own = alignment.aligner(BYTE_RANKS, PIECES)
    runs = sorted({w for t in fuzz(300) for w in t.split(" ") if w} | {"don't", "漢字", "ﬁn", "x" * 60})
    full, bare = own.align(runs), own.align(runs, False)
    assert any(full.groups) and not any(bare.groups)
    for name in ("good", "figures", "pairs", "ends"):
        assert (getattr(full, name) == getattr(bare, name)).all()
    memo = alignment.Remembered(own)
    memo.learn(runs)
    assert not memo.texts and memo.size > 0
