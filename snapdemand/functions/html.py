"""HTML to text with built-in expressions, so no Python worker sits in the scan."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapdemand.functions.text import strip

# Comments, then elements whose content is no text, then any other tag (quoted values may hold '>'). Markup that the
# text ends in the middle of is dropped.
MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(script|style|template)(?=[\s/>]).*?(?:</\1(?=[\s/>])[^>]*>|\z)"
    r"|[/!?a-z][^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+(?:>|\z)"
    r"|[/!?a-z][^>]*+(?:>|\z))"
)
_PAIR, _KEY = "\u0002", "\u0003"
# Names that count without the closing semicolon too; the longest one wins.
_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# Looked up from the front, so the names that make up almost all references come first.
_COMMON = ("amp", "nbsp", "lt", "gt", "quot", "apos", "copy", "middot", "rsquo", "lsquo", "ldquo", "rdquo", "ndash",
           "mdash", "hellip", "bull")
_NAMES = {n: html5[n + ";"] for n in _COMMON} | {n[:-1]: v for n, v in html5.items() if n.endswith(";")}
_WINDOWS_1252 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _joined(entries: dict[str, str]) -> str:
    return _PAIR.join(f"{k}{_KEY}{v}" for k, v in entries.items())


_ALL_NAMES, _LEGACY_NAMES = _joined(_NAMES), _joined({n: html5[n] for n in _LEGACY})


def _names(joined: str) -> Column:
    """A map that the optimiser folds to a single literal."""
    return F.str_to_map(F.lit(joined), F.lit(_PAIR), F.lit(_KEY))


def _code_point(n: Column) -> Column:
    utf32 = F.unhex(F.lpad(F.hex(n), 8, "0"))
    return (
        F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), chr(0xFFFD))
        .when(n.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS_1252), (n - 0x7F).cast("int"), F.lit(1)))
        .when(n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F)
              | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE), "")
        .otherwise(F.decode(utf32, "UTF-32"))
    )


def _after_ampersand(piece: Column) -> Column:
    number = F.regexp_extract(piece, r"^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
    digits = F.regexp_extract(number, "[0-9a-fA-F]+", 0)
    code = F.when(number.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    name = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]*);", 1)
    named = F.try_element_at(_names(_ALL_NAMES), name)
    legacy = F.regexp_extract(piece, "^(?:" + "|".join(_LEGACY) + ")", 0)
    return (
        F.when(number != "", F.concat(_code_point(code), F.substr(piece, F.length(number) + 1)))
        .when((name != "") & named.isNotNull(), F.concat(named, F.substr(piece, F.length(name) + 2)))
        .when(legacy != "", F.concat(F.try_element_at(_names(_LEGACY_NAMES), legacy),
                                     F.substr(piece, F.length(legacy) + 1)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def unescape_entities(text: Column) -> Column:
    """Named and numeric character references, decoded once."""
    pieces = F.split(text, "&")
    decoded = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_after_ampersand(piece)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def html_to_text(html: Column) -> Column:
    """The text nodes of ``html``, each stripped, blank ones left out, joined by one space. Null stays null."""
    nodes = F.transform(F.split(html, MARKUP), lambda node: strip(unescape_entities(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), " ")
