import random

import pytest

SYLLABLES = "ka lo mi re tu sa ne po vi du ér ßo ñi".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture
def odd_docs(spark):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, and columns named as operators' own."""
    rng = random.Random(5)
    long = prose(rng, 40_000)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two"), (None, "none has an id"), (None, None),
            (5, long), (6, long), (7, prose(rng, 60)), (8, "a" * 50_000), (9, "   \u0000 x"), (10, "😀 " * 100)]
    clash = "key fp hits items words n_words text_key own_id body bucket piece start spans score features tokens".split()
    return spark.createDataFrame(
        [(i, t, *["x"] * len(clash)) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
