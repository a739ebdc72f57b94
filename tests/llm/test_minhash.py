"""Circulant MinHash: exact components against all pairs, and the signature itself."""

import random

import numpy as np
import pytest

from snapdemand.llm import minhash

from .conftest import prose

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SPACES = " \t\n\v\f\r"


def shingles(text, size=3):
    words = "".join(" " if c in SPACES else c for c in (text or "").translate(LOWER)).split(" ")
    words = [w for w in words if w]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def brute(docs, threshold=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= threshold * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= threshold * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(docs):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return out


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def test_components_equal_all_pairs(spark):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(40)]
    for n in (30, 120, 300):
        base = prose(rng, n).split(" ")
        texts += [edited(rng, base, rng.randint(0, n // 12)) for _ in range(40)]
    texts += texts[:15] + [t.upper().replace(" ", "  \n") for t in texts[15:30]]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs))


@pytest.mark.parametrize("words, least", [(400, 1), (4000, 300)])
def test_blocks_of_a_family_meet_each_other(spark, monkeypatch, words, least):
    monkeypatch.setattr(minhash, "BLOCK_WORDS", words)
    monkeypatch.setattr(minhash, "DOCUMENT_WORDS", least)
    rng = random.Random(4)
    base = prose(rng, 100).split(" ")
    docs = [(i, edited(rng, base[: rng.randint(85, 100)], rng.randint(0, 6))) for i in range(90)]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(brute(docs))


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = minhash.near_duplicates(odd_docs).collect()
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(brute(docs), key=key)
    assert minhash.near_duplicates(no_docs).collect() == []


def test_a_group_of_copies_gives_no_more_edges_than_members(spark):
    rng = random.Random(6)
    base = prose(rng, 200).split(" ")
    docs = spark.createDataFrame([(i, edited(rng, base, 2)) for i in range(150)], "doc_id long, text string")
    every = minhash.signed(docs)
    from pyspark.sql import functions as F
    distinct = every.withColumn("sid", F.col("doc_id")).withColumn("lead", F.struct(F.lit(False).alias("none"), "doc_id", "key"))
    edges = minhash.links(docs, distinct).collect()
    assert 0 < len(edges) < 150


def test_signature_is_the_least_value_under_each_shift():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 64, 50, dtype=np.uint64)
    first, shifted = minhash._permutations(minhash.SEED, 16)
    second = shifted[:, 0]
    slots = first[(hashes >> np.uint64(42)).astype(np.int64)].astype(np.int64)
    want = [second[(slots + k) % minhash.SLOTS].min() for k in range(16)]
    assert minhash.signature(hashes, 16).tolist() == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(8)
    both, a, b = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (800, 100, 100))
    one, two = (minhash.signature(np.concatenate((both, x)), 256) for x in (a, b))
    assert abs((one == two).mean() - 0.8) < 0.1
