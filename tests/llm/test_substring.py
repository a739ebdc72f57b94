import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from snapdemand.llm import substring
from snapdemand.llm import words as W

from .conftest import prose


def brute(docs, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    times = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, split):
        gone = {j for i in range(len(w) - window + 1) if times[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def result(docs, **options):
    return sorted((tuple(r) for r in substring.without_repeats(docs, **options).collect()), key=repr)


def corpus(seed, window):
    rng = random.Random(seed)
    shared = [prose(rng, rng.choice([window - 1, window, window + 1, 3 * window])) for _ in range(6)]
    shared.append("ka " * (2 * window))
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(prose(rng, rng.randint(0, 2 * window)))
            if rng.random() < 0.5:
                parts.append(rng.choice(shared))
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    return docs + [(100, docs[3][1]), (101, docs[3][1]), (102, "po " * (window - 1)), (103, "po " * (window + 3))]


def test_equals_brute_force_with_hot_minimisers_and_without(spark):
    for seed, window in ((1, 8), (2, 35)):
        docs = corpus(seed, window)
        df, want = spark.createDataFrame(docs, "doc_id long, text string"), brute(docs, window)
        assert result(df, window=window) == want
        assert result(df, window=window, hot_from=3, bucket_bytes=2000) == want


def test_super_kmers_hold_every_window_once_and_meet():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "b", "c"], k=n)) for n in (0, 4, 5, 6, 50, 300)]
    words = W.split(pa.array(texts))
    plain = substring.super_kmers(words, 5, 2, np.zeros(0, np.uint64))
    for hot in (np.zeros(0, np.uint64), np.unique(plain[2])[::2]):
        first, n, bucket = substring.super_kmers(words, 5, 2, hot)
        windows = np.concatenate([np.arange(a, a + k) for a, k in zip(first, n)])
        assert windows.tolist() == W.window_starts(words.first, 5).tolist()
        homes = {}
        for a, k, b in zip(first, n, bucket):
            for i in range(a, a + k):
                homes.setdefault(words.text[words.start[i]:words.end[i + 4]], set()).add(int(b))
        assert all(len(h) == 1 for h in homes.values())


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert result(odd_docs) == brute(docs, 35)
    assert result(odd_docs.union(odd_docs)) == brute(docs + docs, 35)
    assert result(no_docs) == []
