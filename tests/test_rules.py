"""Labels by a table of rules against labels by expressions."""

import random

from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import FOLDING_CHARS, Entry, Rule, required_literals, rx, rx_lower
from snapdemand.operators.classify import classify
from snapdemand.operators.dictionary import classify_by_table, tag_by_table
from snapdemand.operators.tagging import tag

RULES = [
    Rule("role_family", 20, r"\bdata\b", "data_analysis"), Rule("role_family", 20, r"\bengineer\b", "ai_ml"),
    Rule("role_family", 10, r"\bsoft\w+", "software"), Rule("role_family", 30, r"\bx\b", "short"),
    Rule("role_family", 30, r"^.$", "one"), Rule("seniority", 5, r"\b(jr|sr)\.?\b", "some"), Rule("seniority", 4, r"sr\.", "senior"),
    Rule("seniority", 9, r"\bkelvin\b", "cold")]


def test_equals_expressions(spark):
    rng = random.Random(7)
    parts = ["data", "Engineer", "SOFTware", "x", "jr", "Sr.", "Kelvin", "kelvin", "database", "é", "", "data engineer"]
    texts = [(i, " ".join(rng.choices(parts, k=rng.randint(0, 4)))) for i in range(300)] + [(300, None), (301, "é"), (302, "x")]
    docs = spark.createDataFrame(texts, "id int, title string")
    table = spark.createDataFrame([(r.field, r.priority, r.pattern, r.value) for r in RULES] + [("role_family", 1, None, "never")],
                                  model.RULES_SCHEMA)
    got = classify_by_table(docs, ["id"], "title", table).collect()
    want = classify(docs, "title", RULES).select("id", "role_family", "seniority").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len({r.role_family for r in got}) > 4


def test_no_rule_becomes_part_of_the_plan(spark, tmp_path):
    spark.createDataFrame([("role_family", i, rf"\bword{i}\b", f"v{i}") for i in range(2000)], model.RULES_SCHEMA).write.parquet(str(tmp_path / "r"))
    docs = spark.createDataFrame([(1, "a word1999 and word7"), (2, "none")], "id int, title string")
    rows = classify_by_table(docs, ["id"], "title", spark.read.parquet(str(tmp_path / "r")))
    assert sorted(map(tuple, rows.collect())) == [(1, "v7", "mid"), (2, "other", "mid")]
    assert "word1999" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_patterns_without_a_triple_are_tested_in_one_pass(spark):
    dictionary = spark.createDataFrame([("R", "lang", r"\br\b"), ("any", "x", r"^..$"), ("C", "lang", r"\bc\b")], model.DICTIONARY_SCHEMA)
    texts = spark.createDataFrame([(1, "R and c"), (2, "ab"), (3, None)], "id int, text string")
    rows = tag_by_table(texts, ["id"], "text", dictionary)
    assert sorted(map(tuple, rows.select("id", "skill").collect())) == [(1, "C"), (1, "R"), (2, "any")]
    assert rows.groupBy("id").agg(F.count("*")).count() == 2


def test_triples_and_literals_of_any_letters(spark):
    entries = [Entry("é", "x", r"\bé\w"), Entry("phone", "x", r"\b\d{3}[-. ]\d{4}\b"), Entry("c++", "x", r"\bc\+\+"), Entry("mail", "x", r"[\w.]+@[\w.]+"),
               Entry("emoji", "x", "a\U0001F600b"), Entry("large", "x", r"ÉCOLE|straße"), Entry("kind", "x", r"\bkind\b"), Entry("ski", "x", r"ski\w"),
               Entry("times", "x", r"\b\d{0,2}x\b"), Entry("all", "x", "")]
    texts = ["École", "été ÉTÉ", "x é", "555-1234", "a555-1234", "1555-1234", "call 555 1234.", "C++ or c+", "a.b@c", "@", "a\U0001F600b", "\U0001F600\U0001F600",
             "une école", "STRASSE straße", "Kind", "ſki lift ſkis", "SKIING kind", "İx", "12x", "123x", "", "ab", None, "ıİ KINd", "DÉJÀ vu"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(e.skill, e.category, e.pattern) for e in entries] + [("none", "x", None)], model.DICTIONARY_SCHEMA)
    exact = [(e, F.col("text").rlike(rx(e.pattern))) for e in entries]
    want = docs.select("id", F.explode(F.array_compact(F.array(*[F.when(hit, F.lit(e.skill)) for e, hit in exact]))).alias("skill")).collect()
    for found in (tag_by_table(docs, ["id"], "text", table), tag(docs, ["id"], "text", entries)):
        assert sorted(map(tuple, found.select("id", "skill").collect())) == sorted(map(tuple, want))
    assert len({r.skill for r in want}) == len(entries)


def test_patterns_run_where_their_literals_are(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    table = spark.createDataFrame([("at", "x", r"\w@\w")], model.DICTIONARY_SCHEMA)
    plan = tag_by_table(docs, ["id"], "text", table)._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(_literals" in plan and "regexp_extract_all" not in plan and FOLDING_CHARS not in plan
    assert required_literals(r"\bé\w") == ("é",) and required_literals(r"\bß") == ()
    assert rx_lower(r"\b\d{3}x\b") == r"(?d)(?<![0-9A-Za-z_])\d{3}x(?![0-9A-Za-z_])"
