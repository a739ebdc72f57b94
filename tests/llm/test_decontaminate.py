import random
import re

from snapdemand.llm import decontaminate

from .conftest import prose


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def result(docs, items, **options):
    found = decontaminate.contamination(docs, items, **options).select(
        "doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted((tuple(r) for r in found), key=repr)


def case(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([1, 2, 4, 5, 9, 10, 11, 30]))) for i in range(40)]
    items += [(50, items[3][1]), (51, "ka " * 15), (52, None), (53, ""), (54, " ".join(i[1] for i in items[:4]))]
    docs = []
    for d in range(60):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 10))
            parts += [rng.choice([", ", "-", "\n"]).join(w[a:a + rng.choice([9, 10, 12, 30])]).upper(), prose(rng, 5)]
        docs.append((d, " ".join(parts)))
    docs += [(90, "ka " * 9), (91, "ka " * 10), (92, "ka " * 200)]
    return docs, items


def test_equals_brute_force_in_one_block_and_in_many(spark):
    for seed in (1, 2, 3):
        docs, items = case(seed)
        d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        want = brute(docs, items)
        assert result(d, b) == want
        assert result(d, b, block_bytes=700) == want


def test_any_shared_window_shares_a_fingerprint():
    import numpy as np
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 5, 300).astype(np.uint64)
    picked = set(decontaminate.winnow(hashes, np.array([0, 120, 300]), 6).tolist())
    for low, high in ((0, 120), (120, 300)):
        for i in range(low, high - 5):
            assert picked & set(range(i, i + 6))


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "none has an id"), (None, "two"), (2, None), (3, "?!")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert result(odd_docs, items) == brute(docs, [(1, "none has an id"), (None, "two"), (2, None)])
    kept = decontaminate.decontaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(docs) - 2
    assert result(no_docs, items) == []
    assert decontaminate.contamination(odd_docs, items.limit(0)).where("contaminated").count() == 0


def test_repeated_words_cost_no_more_than_others(spark):
    import time

    import pyarrow as pa
    block = decontaminate._block([{"item_id": 1, "text": "ka " * 2000}, {"item_id": 2, "text": "lo mi " * 1000}], 10, 5)
    began = time.monotonic()
    words, hit, found = decontaminate._hits(pa.array(["ka " * 200_000, "mi lo " * 100_000]), block, 10, 5)
    assert time.monotonic() - began < 5
    assert hit.all() and len(hit) == 400_000 and len(found) == 3
