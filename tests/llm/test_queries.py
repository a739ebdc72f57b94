"""Every registered query with its production parameters over whole given tables, against the brute-force versions."""

import zlib

import pytest

import __spark_entry__ as entry
from snapdemand.llm import queries

from . import (
    test_chat, test_decontaminate, test_lexical, test_minhash, test_packing, test_pii, test_prefix_trie, test_quality, test_secrets,
    test_simhash, test_substring,
)

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, FOLDER)


def test_all_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert set(queries.SQL) <= set(entry.oracle_sql())


def test_op1(spark, docs):
    got = run(spark, "op1_substring_dedup").select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == [r[:4] for r in sorted(test_substring.brute(docs, 35))]


def test_op3(spark, docs):
    got = run(spark, "op3_simhash_near_dedup").select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(test_simhash.brute(docs)[0])


def test_op4(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.MARKED_TEXT), (-7, 1, "assistant", queries.MARKED_TEXT)]
    got = run(spark, "op4_chat_formatting").drop("formatted_chars").collect()
    assert sorted(map(tuple, got), key=repr) == test_chat.brute(rows)


def test_op5(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_quality_rules").collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        want = test_quality.brute(text)
        assert {n: got[i][n] for n in want} == want
        assert got[i].base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (got[i].base_failed and got[i].kept)


def test_op6(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op6_toxicity").collect()}
    assert set(got) == {i for i, _ in docs}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for i, r in got.items())


def test_op7(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = run(spark, "op7_benchmark_decontamination").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    want = [(d, n, h, len(f), test_chat.digest(",".join(f)), c) for d, n, h, f, c in test_decontaminate.brute(docs, items)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_op8(spark, docs):
    from snapdemand.llm import packing
    rows = packing.packed(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    test_packing.check_pieces(rows, docs, 2048)
    test_packing.check_places(rows, 2048)
    assert set(run(spark, "op8_best_fit_packing").columns) == {
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_op9(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op9_secret_scans").collect()}
    for i, text in docs:
        want = test_secrets.base(text)
        assert got[i].base_sha256 == test_chat.digest(",".join(f"{k}:{a}:{b}" for k, a, b in want))
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(w[0] == k for w in want) for k in ("assign", "access", "hex")]


def test_op10(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op10_pii").collect()}
    for i, text in docs:
        want = test_pii.brute(text)
        assert got[i].base_sha256 == test_chat.digest(want)
        assert got[i].n_email + got[i].n_ip + got[i].n_card + got[i].n_phone == len([w for w in want.split(",") if w])


def test_op11(spark, docs):
    got = run(spark, "op11_minhash_near_dedup").select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(test_minhash.brute(docs))


def test_op12(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = run(spark, "op12_ranked_lexical_search").select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == test_lexical.brute(docs, items)


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = run(spark, "op13_conversation_prefix_trie").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == test_prefix_trie.brute(rows)
