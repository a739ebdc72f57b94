"""Tags of texts by a dictionary of regular expressions.

The dictionary is code, not data: its entries become expressions, so tagging needs no join and no shuffle. Most entries
are plain words; for them a text is cut into words once and compared as a set. The other patterns run on the text
lower-cased once. Texts with characters whose case folding leaves ASCII take the exact patterns for all entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdemand.functions.regex import FOLDING_CHARS, Entry, matches_lower, plain_words, rx

_WORD = "[0-9a-z_]+"


def _entry(e: Entry) -> Column:
    return F.struct(F.lit(e.skill).alias("skill"), F.lit(e.category).alias("category"))


def _tested(tests: Sequence[tuple[Entry, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(hit, _entry(e)) for e, hit in tests]))


def _word_table(words: Sequence[tuple[str, Entry]]) -> Column:
    """word -> entries, folded to one literal by the optimiser."""
    grouped: dict[str, list[Entry]] = {}
    for word, e in words:
        grouped.setdefault(word, []).append(e)
    return F.map_from_entries(F.array(*[
        F.struct(F.lit(w), F.array(*[_entry(e) for e in es])) for w, es in grouped.items()]))


def with_tags(df: DataFrame, text: str, dictionary: Sequence[Entry], into: str = "tags") -> DataFrame:
    """Adds the array of distinct (skill, category) pairs found in ``text``; empty for a null text."""
    words = [(w, e) for e in dictionary for w in plain_words(e.pattern) or ()]
    others = [e for e in dictionary if plain_words(e.pattern) is None]
    empty = F.array().cast("array<struct<skill:string,category:string>>")

    exact = _tested([(e, F.col(text).rlike(rx(e.pattern))) for e in dictionary]) if dictionary else empty
    found = []
    if words:
        found_words = F.regexp_extract_all("_lower", F.lit(_WORD), F.lit(0))
        hits = F.array_intersect(found_words, F.array(*[F.lit(w) for w in dict.fromkeys(w for w, _ in words)]))
        table = _word_table(words)
        found.append(F.flatten(F.transform(hits, lambda w: F.element_at(table, w))))
    if others:
        found.append(_tested([(e, matches_lower(F.col("_lower"), e.pattern)) for e in others]))
    fast = F.concat(*found) if found else empty

    prepared = df.withColumn("_lower", F.lower(text))
    tags = (
        F.when(F.col(text).isNull(), empty)
        .when(F.col(text).rlike(FOLDING_CHARS), exact)
        .otherwise(fast)
    )
    return prepared.withColumn(into, F.array_distinct(tags)).drop("_lower")


def tag(df: DataFrame, keys: Sequence[str], text: str, dictionary: Sequence[Entry], partitions: int | None = None) -> DataFrame:
    """One row per key and tag. ``keys`` must be unique in ``df``, as they are in entity tables.

    A Parquet row group is one task, however many patterns its texts are tested with. For tables of few, large row groups
    give ``partitions``: texts are dealt round-robin to so many tasks first, which costs one exchange of them.
    """
    texts = df.select(*keys, text)
    tagged = with_tags(texts if partitions is None else texts.repartition(partitions), text, dictionary)
    return explode_tags(tagged, keys)


def explode_tags(tagged: DataFrame, keys: Sequence[str], tags: str = "tags") -> DataFrame:
    # explode_outer, then a filter: explode would make the optimiser test the array beforehand, and so build it twice
    return (
        tagged.select(*keys, F.explode_outer(tags).alias("_tag"))
        .where(F.col("_tag").isNotNull())
        .select(*keys, "_tag.skill", "_tag.category")
    )
