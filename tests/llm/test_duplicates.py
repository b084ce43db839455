"""Fingerprints, SimHash groups and components against brute force."""

import base64
import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from bazaarline.llm import fingerprints, simhash
from bazaarline.llm.components import components
from bazaarline.llm.queries import QUERIES
from odd import SMALL, no_docs, odd_docs


def slow_cuts(data, how):
    """The definition, byte by byte."""
    strict, loose = how.masks()
    gear = fingerprints.gear().tolist()
    out, start, h = [], 0, 0
    for i, b in enumerate(data):
        h = (h << 1) + gear[b] & 0xFFFF
        size = i + 1 - start
        mask = strict if size < how.normal else loose
        if size >= how.least and h & mask == 0 or size == how.most:
            out.append(i + 1)
            start = i + 1
    if start < len(data):
        out.append(len(data))
    return out


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=1500), st.sampled_from([fingerprints.Chunking(), fingerprints.Chunking(4, 8, 30)]))
def test_cuts_follow_the_definition(data, how):
    assert fingerprints.cuts(data, how) == slow_cuts(data, how) if data else True


def test_shift_resistance_and_containment():
    how, rng = fingerprints.Chunking(), np.random.default_rng(3)
    text = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(2000))
    print_ = lambda t: fingerprints.written(fingerprints.chunk_set(t, how))
    assert fingerprints.shared(print_(text), print_("inserted " + text)) > 0.98
    assert fingerprints.shared(print_(text[:5000]), print_(text)) > 0.97
    assert fingerprints.shared(print_(text), print_(text[:3500])) == pytest.approx(0.25, abs=0.02)
    assert fingerprints.shared(print_(""), print_("")) == 1 and fingerprints.shared(print_(""), print_("a")) == 0
    assert fingerprints.shared(print_("a"), print_("")) == 0
    digests, lengths = fingerprints.parsed(print_(text))
    assert dict(zip(digests.tolist(), lengths.tolist())) == fingerprints.chunk_set(text, how)


def edited_by_hand(texts):
    out = []
    for i, t in enumerate(texts):
        n = len(t) // 4
        out.append(t[: len(t) - n] + texts[(i + 1) % len(texts)][:n])
    return out


def test_fingerprint_query(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    texts = [r.text or "" for r in docs]
    made = {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SMALL).collect()}
    assert len(made) == len(docs)
    how = fingerprints.Chunking()
    sets = [fingerprints.chunk_set(t, how) for t in texts]
    for i, (row, edited) in enumerate(zip(docs, edited_by_hand(texts))):
        r, own, other = made[row.doc_id], sets[i], fingerprints.chunk_set(edited, how)
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, chunks in ((r.near_edited, other), (r.near_next, sets[(i + 1) % len(sets)])):
            share = sum(n for d, n in own.items() if d in chunks) / sum(own.values()) if own else float(not chunks)
            assert near == pytest.approx(share)
        assert len(base64.b64decode(r.fingerprint)) == 7 * len(own)


def test_fingerprints_of_odd_documents(odd_docs, no_docs, spark):
    rows = fingerprints.edited_and_next(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_text = {r.doc_id: r.fingerprint for r in rows}
    assert by_text[0] == by_text[1] == "" and by_text[5] == by_text[6] == by_text[None] != ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert next(r for r in rows if r.doc_id == 5).near_next == 1
    assert fingerprints.edited_and_next(no_docs).count() == 0
    one = spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")
    assert fingerprints.edited_and_next(one).first().edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def slow_simhash(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest position reachable over links of at most three bits."""
    least = list(range(len(prints)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                a_root, b_root = root(i), root(j)
                least[max(a_root, b_root)] = min(a_root, b_root)
    return [root(i) for i in range(len(prints))]


def test_golay_code_is_perfect():
    leaders, syndromes = simhash.golay()
    assert len(set(leaders.tolist())) == 2048 and max(int(e).bit_count() for e in leaders) == 3
    words = np.random.default_rng(0).integers(0, 1 << 23, 500, dtype="u4")
    codewords = words ^ leaders[syndromes[words]]
    assert not syndromes[codewords].any()


def test_near_indices_meet_at_distance_one():
    words = np.random.default_rng(1).integers(0, 1 << 23, 300, dtype="u4")
    rows, index = simhash.near(words, 23)
    assert set(np.bincount(rows).tolist()) <= {1, 6}
    held = [set(index[rows == i].tolist()) for i in range(len(words))]
    for bit in range(23):
        for i, other in enumerate(simhash.decode(words ^ np.uint32(1 << bit)).tolist()):
            assert other in held[i]


def test_keys_find_every_link():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**64, 400, dtype="u8")
    other = prints.copy()
    for i in range(len(prints)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    (rows, wide), (more, narrow) = simhash.keys(prints, True), simhash.keys(other, False)
    held = [set(wide[rows == i].tolist()) for i in range(len(prints))]
    assert all(held[i] & set(narrow[more == i].tolist()) for i in range(len(prints)))


def test_links_and_groups_of_close_fingerprints(spark):
    """Chains and clusters of fingerprints a few bits apart, linked exactly."""
    rng = np.random.default_rng(4)
    prints = set()
    for _ in range(12):
        value = int(rng.integers(0, 2**63))
        for _ in range(25):
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                value ^= 1 << int(bit)
            prints.add(value)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    pairs = {frozenset(r) for r in found.collect()}
    close = {
        frozenset((signed[i], signed[j]))
        for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3
    }
    assert pairs == close and len(close) > 50
    roots = {r.node: r.root for r in components(found).collect()}
    expected = slow_groups(prints)
    together = {}
    for p, g in zip(signed, expected):
        together.setdefault(g, set()).add(roots.get(p, p))
    assert all(len(r) == 1 for r in together.values()) and len(set.union(*together.values())) == len(together)
    with pytest.raises(ValueError):
        simhash.links(found, 4)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 40)]
    edges = spark.createDataFrame([*chain, *star, (5, 6), (6, 5), (9, 9), (None, 3), (3, None)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 40)}}
    assert components(edges.where("false")).count() == 0


def test_simhash_query(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    prints = [slow_simhash(r.text) for r in docs]
    made = {r.doc_id: r for r in QUERIES["op9_simhash"](spark, SMALL).collect()}
    assert [made[r.doc_id].fingerprint for r in docs] == [f"{p:016x}" for p in prints]
    assert [made[r.doc_id].component_id for r in docs] == [docs[i].doc_id for i in slow_groups(prints)]


def test_simhash_of_odd_documents(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in odd_docs.collect():
        assert by_id[r.doc_id].fingerprint == f"{slow_simhash(r.text):016x}"
    assert [by_id[i].component_id for i in (0, 1, 2, 3, 6, None)] == [0, 0, 0, 3, 5, 5]
    kept = simhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 3 and {0, 5} <= set(ids) and not {1, 2, 6, None} & set(ids)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicated(no_docs).count() == 0
