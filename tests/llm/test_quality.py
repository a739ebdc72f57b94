import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from snapdemand.llm import boosting, quality

from .conftest import prose


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeat = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(repeat)}


def texts(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "a", "x y   z", "😀 " * 30]
    for _ in range(200):
        few = prose(rng, 8).split()
        out.append("".join(rng.choice(few) + rng.choice([" ", " ", "\n", "\n\n", "\t", "# ", "*** ", " | "]) for _ in range(rng.randint(0, 60))))
    return out


def test_counts_equal_brute_force():
    for seed in (1, 2):
        given = texts(seed)
        found = quality.statistics(pa.array(given, pa.string()))
        for i, text in enumerate(given):
            assert {n: int(found[n][i]) for n in quality.COUNTS} == brute(text), repr(text)


def test_trees_learn_and_keep_the_order_they_must():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    model = boosting.fit(x[:3000], y[:3000], trees=40)
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97
    # the truth rises and falls with feature 2, the model may only fall
    y = (np.abs(x[:, 2] - 0.5) < 0.2).astype(float)
    model = boosting.fit(x, y, {2: -1})
    grid = np.repeat(rng.random((50, 3))[:, None], 40, 1)
    grid[:, :, 2] = np.linspace(-0.1, 1.1, 40)
    scores = model.margin(grid.reshape(-1, 3)).reshape(50, 40)
    assert (np.diff(scores, axis=1) <= 1e-12).all()
    constant = boosting.fit(np.zeros((0, 3)), np.zeros(0))
    assert np.allclose(constant.probability(x[:5]), 0.5)


def sample(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        words = prose(rng, rng.randint(60, 120)).split()
        docs.append((i, " ".join(w if good or rng.random() < 0.4 else w + "***" for w in words)))
        if i < 300:
            labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_verdicts_on_documents_without_a_label(spark):
    docs, labels = sample(spark)
    rows = quality.rated(docs, labels).collect()
    assert len(rows) == 400 and [r for r in rows if r.doc_id >= 300 and r.kept != (r.doc_id % 4 != 0)] == []
    kept = quality.kept(docs, labels)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)


def test_odd_rows(spark, odd_docs, no_docs):
    _, labels = sample(spark)
    labels = labels.union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int"))
    rows = quality.rated(odd_docs, labels).collect()
    want = sorted(((r.doc_id, brute(r.text)) for r in odd_docs.select("doc_id", "text").collect()), key=repr)
    assert sorted(((r.doc_id, {n: r[n] for n in quality.COUNTS}) for r in rows), key=repr) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert quality.kept(odd_docs, labels).columns == odd_docs.columns
    assert quality.rated(no_docs, labels).count() == 0 == quality.kept(no_docs, labels).count()
    assert quality.rated(odd_docs, labels.limit(0)).count() == len(rows)


def test_a_repeated_id_is_fitted_on_once(spark, monkeypatch):
    docs, labels = sample(spark)
    docs, labels = docs.where("doc_id < 60"), labels.where("doc_id < 60")
    more = spark.range(8).crossJoin(labels).select("doc_id", "quality")
    taken = []
    monkeypatch.setattr(quality, "fit", lambda x, y, monotonic: taken.append((len(x), len(np.unique(x, axis=0)), y.sum())))
    quality.train(quality.counted(docs.union(docs).union(docs)), more.union(labels), rows=40)
    quality.train(quality.counted(docs), labels, rows=40)
    assert taken[0] == taken[1] and taken[0][:2] == (40, 40)
