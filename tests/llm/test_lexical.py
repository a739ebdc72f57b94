"""Ranked search against plain Python scores of all documents."""

import math
import random
import re

import pytest

from snapdemand.llm import lexical

from .conftest import prose

TERM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    said = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in said), sum(len(t) for _, t in said)
    df = {}
    for _, t in said:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in said:
            if t:
                m, score = 25 + 75 * len(t) * n_docs // total, 0
                for x in terms(text):
                    if x in df:
                        tf = t.count(x)
                        score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                if score > 0:
                    scored.append((-score, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def run(docs, items, **options):
    return sorted(map(tuple, lexical.search(lexical.index(docs), items, **options).collect()), key=repr)


def given(seed, n=300):
    rng = random.Random(seed)
    pool = [prose(rng, 1) for _ in range(80)]
    docs = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 90)))) for i in range(n)]
    items = [(q, " ".join(rng.choices(pool, k=rng.randint(0, 20)))) for q in range(20)]
    return docs, items


@pytest.mark.parametrize("seed, top", [(1, 10), (2, 1), (3, 400)])
def test_equals_scores_of_all_documents(spark, monkeypatch, seed, top):
    monkeypatch.setattr(lexical, "BATCH", 32)
    monkeypatch.setattr(lexical, "STEP", 4)
    docs, items = given(seed)
    got = run(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), top=top)
    assert got == brute(docs, items, top)


def test_blocks_of_queries_and_few_coordinates_change_nothing(spark, monkeypatch):
    docs, items = given(4)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 3)
    assert run(*frames) == brute(docs, items)


def test_frequencies_beyond_what_a_sketch_tells(spark):
    docs = [(1, "word " * 1000), (2, "word " * 255 + "other"), (3, "word"), (4, "other " * 300 + "word")]
    items = [(1, "word"), (2, "other word word")]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)


def test_ties_go_by_id_and_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "one two has an id"), (2, None), (3, ""), (4, "nothing-like-this 😀"), (4, "nothing-like-this 😀"), (None, "ONE")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs, frame) == brute(docs, [items[0], items[3], items[5]])
    assert run(no_docs, frame) == [] and run(odd_docs, frame.limit(0)) == []
    same = [(i, "the very same words") for i in range(40, 0, -1)] + [(99, "other")]
    got = run(spark.createDataFrame(same, "doc_id long, text string"), spark.createDataFrame([(7, "same words")], "item_id long, text string"))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))
