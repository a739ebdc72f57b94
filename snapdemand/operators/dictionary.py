"""Tags and labels by patterns that are a table of any size: an equality join on words or character triples, then the pattern.

Use it for dictionaries that grow; ``operators.tagging`` turns a handful of entries into expressions instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand import model
from snapdemand.functions.regex import plain_words, required_literals, rx, rx_lower

_GRAM = 3
_FOLDING = "\u0130\u0131\u017f\u212a"
_COMPILED = ("_java", "_java_lower", "_literals")


_WORD = re.compile("[0-9a-z_]+")
#: texts of which Python holds the words or triples at a time
_ROWS = 256


def _triples(text: str) -> np.ndarray:
    """The different character triples of a text, each as one number: a character takes 21 bits."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]) if len(codes) >= _GRAM else codes[:0]


def _words(text: str) -> list[str]:
    return list(set(_WORD.findall(text)))


def _grams(texts: Sequence[str]) -> list[int] | None:
    """One character triple of each text; None if a text is shorter, or there is none."""
    return list(dict.fromkeys(int(_triples(t[:_GRAM])[0]) for t in texts)) if texts and min(map(len, texts)) >= _GRAM else None


def _exploded(df: DataFrame, text: str, parts: Callable[[str], Sequence], into: str, kind: str) -> DataFrame:
    """``df`` with the parts of ``text`` in its place, one a row. Lists leave Python by a few hundred texts."""
    held, kinds = [c for c in df.columns if c != text], {"string": pa.string(), "bigint": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in (batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS)):
                lists = [parts(t) for t in few.column(few.schema.get_field_index(text)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[few.column(few.schema.get_field_index(c)) for c in held], pa.array(lists, pa.list_(kinds[kind]))], [*held, into])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)
    return df.mapInArrow(run, f"{fields}, `{into}` array<{kind}>").withColumn(into, F.explode(into))


def compiled(dictionary: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Adds to each row its Java patterns, the words it consists of, and literals and triples of which every match holds one.

    ``_java`` is for any text, ``_java_lower`` for lower-cased texts without ``FOLDING_CHARS``. ``_words`` is null unless the
    pattern is plain words; ``_literals`` and ``_grams`` are null where none can be named.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns = batch.column(batch.schema.get_field_index(pattern)).to_pylist()
            words = [None if p is None else plain_words(p) for p in patterns]
            literals = [None if p is None else w or required_literals(p) or None for p, w in zip(patterns, words)]
            grams = [None if found is None else _grams(found) for found in literals]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([p and java(p) for p in patterns], pa.string()) for java in (rx, rx_lower)],
                 *[pa.array(lists, pa.list_(pa.string())) for lists in (words, literals)],
                 pa.array(grams, pa.list_(pa.int64()))],
                [*batch.schema.names, "_java", "_java_lower", "_words", "_literals", "_grams"])

    added = "_java string, _java_lower string, _words array<string>, _literals array<string>, _grams array<bigint>"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dictionary.schema)
    return dictionary.mapInArrow(run, f"{kinds}, {added}")


def matches_column(text: Column, java: Column) -> Column:
    """Does ``text`` match the compiled pattern of its own row?"""
    return F.rlike(text, java)


def _hit(lowered: Column) -> Column:
    """``matches_column`` at less cost: only odd texts need the exact pattern, and no pattern runs where its literals are missing."""
    held = F.col("_literals").isNull() | F.exists("_literals", lambda literal: F.contains(lowered, literal))
    return F.when(F.col("_odd"), matches_column(F.col("_text"), F.col("_java"))).otherwise(
        held & matches_column(lowered, F.col("_java_lower")))


def _is_odd(text: Column) -> Column:
    """Does ``text`` hold a character of ``FOLDING_CHARS``? Plain substring tests cost less than the pattern."""
    return reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in _FOLDING])


def _folded(text: Column) -> Column:
    """Lower case, with the four characters that fold onto ASCII letters as those letters."""
    return F.lower(F.translate(text, _FOLDING, "iisk"))


def matched(df: DataFrame, keys: Sequence[str], text: str, table: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(keys, the other columns of ``table``) of every row of ``table`` whose ``pattern`` a text matches; maybe more than once.

    A text's different words meet the rows that are plain words; its different triples meet the rows of which every match
    holds such a triple, and the pattern decides. Words and triples that no row asks for find no partner.
    ``keys`` must be unique in ``df``. Texts with characters that fold onto ASCII letters always take the second way. Only rows
    without any triple are tested with all texts, in one pass. Null texts and patterns match nothing.
    """
    columns = [c for c in table.columns if c != pattern]
    entries = compiled(table.select(*columns, pattern), pattern)
    texts = df.select(*keys, F.col(text).alias("_text"), _is_odd(F.col(text)).alias("_odd")).where("_text is not null")
    lower = texts.where("not _odd").select(*keys, F.lower("_text").alias("_text"))
    words = _exploded(lower, "_text", _words, "_word", "string")
    by_word = entries.where("_words is not null").select(*columns, F.explode("_words").alias("_word"))
    found = words.join(by_word, "_word").select(*keys, *columns)

    folded = F.when(F.col("_odd"), _folded(F.col("_text"))).otherwise(F.lower("_text"))
    by_gram = entries.where("_grams is not null").select(
        *columns, *_COMPILED, F.col("_words").isNotNull().alias("_plain"), F.explode("_grams").alias("_gram"))
    # plain words need this way for odd texts only; texts stay out of the join until candidates are known
    held = _exploded(texts.withColumn("_text", folded), "_text", _triples, "_gram", "bigint")
    pairs = held.join(by_gram, "_gram").where("_odd or not _plain").select(*keys, *columns, *_COMPILED).distinct()
    found = found.union(texts.join(pairs, list(keys)).where(_hit(F.lower("_text"))).select(*keys, *columns))

    # patterns that name no triple, such as short words: a join on the pattern itself
    others = entries.where("_grams is null and _java is not null").select(*columns, *_COMPILED, F.col("_words").isNotNull().alias("_plain"))
    lowered = texts.withColumn("_lower", F.lower("_text"))
    tested = lowered.join(others, (F.col("_odd") | ~F.col("_plain")) & _hit(F.col("_lower")))
    return found.union(tested.select(*keys, *columns))


def tag_by_table(df: DataFrame, keys: Sequence[str], text: str, dictionary: DataFrame) -> DataFrame:
    """Distinct (keys, skill, category) of every entry of ``dictionary(skill, category, pattern)`` that a text matches; see ``matched``."""
    return matched(df, keys, text, dictionary.select("skill", "category", "pattern")).distinct()


def classify_by_table(df: DataFrame, keys: Sequence[str], text: str, rules: DataFrame,
                      defaults: dict[str, str] = model.RULE_DEFAULTS) -> DataFrame:
    """(keys, one column per field in ``defaults``): the value of the matching rule of lowest priority, by value among equals.

    ``rules`` is (field, priority, pattern, value) and may be of any size: none of it becomes part of the plan. A text no
    rule of a field matches gets the field's default. The least (priority, value) of each field is combined inside
    every task before the shuffle, so a text that thousands of rules match is one row per task.
    """
    hits = matched(df, keys, text, rules.select("field", "priority", "value", "pattern"))
    first = hits.groupBy(*keys).agg(*[
        F.min(F.when(F.col("field") == f, F.struct("priority", "value"))).alias(f"_{f}") for f in defaults])
    return df.select(*keys).join(first, list(keys), "left").select(
        *keys, *[F.coalesce(F.col(f"_{f}.value"), F.lit(d)).alias(f) for f, d in defaults.items()])
