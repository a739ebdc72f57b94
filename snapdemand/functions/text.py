"""String cleaning, keys and string arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs); tab and line breaks are not among them.
SPACE_SEPARATORS = "".join(map(chr, [0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
WHITE_SPACE = SPACE_SEPARATORS + "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0x2028, 0x2029]))
NO_BREAK_SPACE = chr(0xA0)


def trim_zs(text: Column) -> Column:
    """Drop outer space separators."""
    return F.btrim(text, F.lit(SPACE_SEPARATORS))


def strip(text: Column) -> Column:
    """Drop outer white space of any kind, as the payload readers do."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def plain_spaces(text: Column) -> Column:
    """No-break spaces become spaces, then outer space separators go."""
    return trim_zs(F.translate(text, NO_BREAK_SPACE, " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trim_zs(text), F.lit(""))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def first_non_blank(*texts: Column) -> Column:
    """The first text that is neither null nor '', else ''."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def entity_key(*parts: Column, sep: str = ":") -> Column:
    """Parts joined by ``sep``; null when any part is null."""
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit(sep), part]
    return F.concat(*joined)


def searchable(title: Column, description: Column) -> Column:
    """Title and description as one text; null when the title is."""
    return F.concat(title, F.lit(" "), or_empty(description))


def join_distinct(items: Column, sep: str = "; ") -> Column:
    """An array's distinct items in order of first appearance, nulls skipped, joined."""
    return F.array_join(F.array_distinct(F.array_compact(items)), sep)


def stripped_places(places: Column) -> Column:
    """Non-blank places, each stripped."""
    return F.transform(F.filter(places, lambda p: p != ""), strip)


def keep_items(items: Column, pattern: str) -> Column:
    """The array items a pattern matches."""
    from snapdemand.functions.regex import rx

    return F.filter(items, lambda item: item.rlike(rx(pattern)))


def sections_text(sections: Column, sep: str = " ") -> Column:
    """An array of texts joined in order; a null section counts as ''."""
    return F.array_join(F.transform(sections, or_empty), sep)


def last_token(text: Column, sep: str) -> Column:
    """What follows the last ``sep``; the whole text without one."""
    return F.substring_index(text, sep, -1)


def prefix(text: Column, length: int = 10) -> Column:
    return F.substring(text, 1, length)


def lookup(values: dict, key: Column) -> Column:
    """``values[key]`` as a literal map; null for other keys."""
    pairs: Sequence[Column] = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)
