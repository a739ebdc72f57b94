"""The pipeline against a plain version of its stages, over documents whose quality the first stage can tell."""

import random
import zlib

import numpy as np

import corpus_pipeline

from . import test_decontaminate, test_packing, test_quality, test_secrets, test_simhash
from .conftest import prose


def corpus():
    rng = random.Random(8)
    items = [(i, prose(rng, 20)) for i in range(3)]
    docs, labels = [], []
    for i in range(240):
        words = prose(rng, rng.randint(60, 90)).split()
        if i % 4 == 0:
            words = [w + "###" if rng.random() < 0.7 else w for w in words]
        if i % 20 == 1:
            words[5:5] = items[i % 3][1].split()[2:14]
        if i % 10 == 2:
            words[7:7] = ["api_key", "=", "'0123456789abcdef'"]
        docs.append((i, " ".join(words)))
        if i < 200:
            labels.append((i, int(i % 4 != 0)))
    docs += [(300, docs[5][1]), (301, docs[5][1] + " tail"), (302, "too short"), (303, None), (304, "")]
    docs += [(305, docs[6][1]), (305, docs[6][1])]
    return docs, labels, items


def brute(docs, items):
    """Rows that are left, with their texts, and the stage before packing done."""
    good = []
    for i, text in docs:
        s = test_quality.brute(text)
        if s["n_words"] >= 50 and 100 * s["n_repeat_words"] <= 50 * s["n_words"] and s["n_symbols"] < 30:
            good.append((i, text))
    first = {}
    for doc, fp, component in test_simhash.brute(good)[0]:
        first.setdefault(component, doc)
    left = {i: text for i, text in good if i in first}
    clean = [r[0] for r in test_decontaminate.brute(list(left.items()), items) if not r[4]]
    out = []
    for i in clean:
        text, at, parts = left[i], 0, []
        for _, a, b in test_secrets.base(text):
            parts.append(text[at:a])
            at = b
        out.append((i, "[SECRET]".join([*parts, text[at:]])))
    return out


def test_run_equals_the_stages_done_plainly(spark, tmp_path):
    docs, labels, items = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(docs, items)
    assert 100 < len(want) < 170 and any("[SECRET]" in t for _, t in want)
    got = {r.doc_id: r.ids_crc32 for r in rows}
    assert len(rows) == len(got) == len(want)
    assert got == {i: zlib.crc32(np.array(test_packing.ids_of(text), "<u4").tobytes()) for i, text in want}
    test_packing.check_places(rows, 2048)


def test_stages_keep_the_columns_and_bear_odd_and_no_rows(spark, odd_docs, no_docs, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this is there")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, given, str(tmp_path)).schema.names == given.columns, name
            stage(spark, given, str(tmp_path)).count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).count() >= given.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_scans", "best_fit_packing"]
