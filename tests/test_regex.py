"""The regex dialect against DuckDB, over texts on which the two engines are known to differ."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from snapdemand.catalog.views import DOC_DICTIONARY, PART_DICTIONARY, RULES
from snapdemand.functions import regex

ODD = [chr(c) for c in (0x212A, 0x17F, 0x130, 0x131, 0x85, 0x2028, 0x0B, 0xE9)]  # fold onto ASCII, or are space to one engine only
PIECES = ["k", "s", "i", "K", "S", "I", "kiss", "Sik", "_", "7", " ", "\t", "\n", "\r", ".", ",", "$", "-", *ODD]
ATOMS = ["k", "s", "i", "kis", "sk", r"\b", r"\Bk", r"\s", r"\S", r"\w", r"\d", ".", r"\.", "[h-l]", "[^h-l]", "[$,]", "$", "^", "é", r"\-"]


def made(seed, texts=150, patterns=220):
    """Texts and patterns put together at random from what the engines read differently."""
    rng = random.Random(seed)

    def pattern(depth=0):
        out = ""
        for _ in range(rng.randint(1, 4)):
            atom = f"({pattern(1)}|{pattern(1)})" if depth == 0 and rng.random() < 0.2 else rng.choice(ATOMS)
            repeat = rng.choice(["", "", "", "+", "?", "*", "{1,2}"]) if atom not in (r"\b", r"\Bk", "$", "^") else ""
            out += atom + repeat
        return out

    return (["".join(rng.choices(PIECES, k=rng.randint(0, 7))) for _ in range(texts)] + ["", None],
            [pattern() for _ in range(patterns)])


TEXTS, PATTERNS = made(5)
PATTERNS += [e.pattern for e in [*DOC_DICTIONARY, *PART_DICTIONARY]] + [r.pattern for r in RULES]
TEXTS += ["The license. And", "old\tanvil", "brand#7 spare, x", "555 1234", "me@x.y", "ci!! token = 1", "version 2", "red ring",
          "Economy BOLTS", "small Senior rod", "in this"]


@pytest.fixture(scope="module")
def wanted():
    con = duckdb.connect()
    con.execute("CREATE TABLE t(x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(t,) for t in TEXTS])
    return {p: dict(con.execute("SELECT x, regexp_matches(x, ?, 'i') FROM t", [p]).fetchall()) for p in PATTERNS}


def test_every_pattern_means_the_same(spark, wanted):
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    exact = [F.col("x").rlike(regex.rx(p)).alias(f"e{i}") for i, p in enumerate(PATTERNS)]
    quick = [regex.matches(F.col("x"), p).alias(f"q{i}") for i, p in enumerate(PATTERNS)]
    wrong = [(p, r.x, r[f"e{i}"], r[f"q{i}"]) for r in df.select("x", *exact, *quick).collect()
             for i, p in enumerate(PATTERNS) if not r[f"e{i}"] == r[f"q{i}"] == wanted[p][r.x]]
    assert wrong == []


@pytest.mark.parametrize("pattern, words", [
    (r"\bkafka\b", ("kafka",)), (r"\b(k8s|Kubernetes)\b", ("k8s", "kubernetes")), (r"\bpower ?bi\b", None),
    (r"kafka", None), (r"\bc\+\+\b", None),
])
def test_plain_words(pattern, words):
    assert regex.plain_words(pattern) == words


@pytest.mark.parametrize("pattern, literals", [
    (r"\bapache spark\b", ("apache spark",)), (r"(ab(c|d)|ef)x?", ("ab", "ef")), (r"a|b?", ()), (r"node\.?js", ("node",)),
    (r"x(y|z)?wv+", ("wv",)), (r"\d+", ()), (r"\.net", (".net",)), (r"a{0}bcd", ("bcd",)),
])
def test_required_literals(pattern, literals):
    assert regex.required_literals(pattern) == literals


def test_first_match_is_leftmost(spark):
    df = spark.createDataFrame([("b a", ), ("zz",)], "x string")
    assert [r[0] for r in df.select(regex.first_match(F.col("x"), "a|b")).collect()] == ["b", ""]
