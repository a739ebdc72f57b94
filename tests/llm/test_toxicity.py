import random
import zlib

import numpy as np
import pyarrow as pa

from snapdemand.llm import recurrent, toxicity
from snapdemand.llm import words as W

from .conftest import prose


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net = {k: v.astype(np.float64) for k, v in recurrent.new_network(4, 3).items()}
    x, index = rng.standard_normal((6, 4)), rng.integers(0, 6, (5, 7))
    mask = (np.arange(7) < np.array([7, 3, 1, 5, 0])[:, None]).astype(float)
    y, w = np.array([1.0, 0, 1, 0, 1]), np.array([1.0, 2, 1, 1, 0.5])
    _, g, d_x = recurrent.gradients(net, x, index, mask, y, w)

    def loss():
        return recurrent.gradients(net, x, index, mask, y, w)[0]

    for values, gradient in [*((net[k], g[k]) for k in g), (x, d_x)]:
        flat = values.reshape(-1)
        for i in rng.choice(flat.size, min(5, flat.size), replace=False):
            before = flat[i]
            flat[i] = before + 1e-4
            up = loss()
            flat[i] = before - 1e-4
            down = loss()
            flat[i] = before
            assert abs((up - down) / 2e-4 - gradient.reshape(-1)[i]) < 1e-4


def test_windows_overlap_and_cover_every_word():
    words = W.split(pa.array([None, "a", " ".join("abcdefgh") * 2, "x " * 32, "x " * 33, "y " * 500]))
    start, length, begin = toxicity._windows(words)
    for d, n in enumerate(words.counts.tolist()):
        own = slice(begin[d], begin[d + 1])
        s, k = start[own] - words.first[d], length[own]
        assert (s == 16 * np.arange(len(s))).all() and s[-1] + k[-1] == n and (k[:-1] == 32).all()


def labelled(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = prose(rng, rng.choice([10, 60, 200])).split()
        bad = i % 3 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Gruffo!", "zwixkel", "zwixen", "Zwixbar,", "gruffo"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_documents(spark):
    rows = labelled(1500, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (10 ** 6, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (i in set(held)) for i in got) and len(got) == 1500
    right = sum(got[i].predicted == rows[i][2] for i in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    # a form never seen, known by its characters
    model = toxicity.train(docs, labels)
    assert model.scores(pa.array(["ka lo mi zwixhaft re tu zwixur sa"]))[0] > 0.5 > model.scores(pa.array(["ka lo mi re tu sa"]))[0]


def test_labels_of_held_out_documents_are_not_learnt_from(spark):
    rows = labelled(300, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    turned = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows], "doc_id long, toxic int")
    a, b = (sorted(toxicity.scored(docs, toxicity.train(docs, x)).collect()) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark, odd_docs, no_docs):
    rows = labelled(200, 3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels)
    got = toxicity.scored(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labels)
    assert len({r.score for r in toxicity.scored(odd_docs, none).collect()}) == 1
    assert len({r.score for r in toxicity.scored(odd_docs, toxicity.train(odd_docs, labels.limit(0))).collect()}) == 1
