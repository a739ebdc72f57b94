r"""Regular expressions with the meaning they have in the warehouse's SQL dialect (RE2, case-insensitive).

Java reads four things differently: ``\b`` looks at Unicode letters, ``$`` also stops before a final line break,
``\s`` also takes the vertical tab, and case folding maps the dotted and dotless i onto ``i``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = "0-9A-Za-z_"
_BOUNDARY = f"(?-iu:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"
_WORD_START = f"(?<![{_WORD}])"
_WORD_END = f"(?![{_WORD}])"
_SPACE = r" \t\n\f\r"
_TURKIC_I = r"\u0130\u0131"

# Characters whose case folding leaves ASCII: long s, Kelvin sign, dotted and dotless i. A text without them can be
# lower-cased once and matched with cheaper patterns.
FOLDING_CHARS = r"[\u0130\u0131\u017F\u212A]"

_TOKEN = re.compile(
    r"\\[pP]\{[^}]*\}|\\x\{[^}]*\}|\\x[0-9A-Fa-f]{2}|\\.|\[\^?\]?(?:\\.|\[:\^?\w+:\]|[^\]\\])*\]|\(\?[^)(]*[:)]|.",
    re.DOTALL,
)
_OPTIONAL = ("?", "*", "{")
#: letters beyond ASCII onto which nothing folds that ``lower`` does not make the same letter
_FOLD_ALONE = "\u00e0\u00e1\u00e2\u00e3\u00e4\u00e6\u00e7\u00e8\u00e9\u00ea\u00eb\u00ec\u00ed\u00ee\u00ef\u00f1\u00f2\u00f3\u00f4\u00f5\u00f6\u00f8\u00f9\u00fa\u00fb\u00fc"


def _is_word(token: str) -> bool:
    return token in (r"\d", r"\w") or len(token) == 1 and token.isascii() and (token.isalnum() or token == "_")


def _closing(tokens: list[str], start: int) -> int:
    depth = 0
    for i in range(start, len(tokens)):
        if tokens[i].startswith("(") and not (tokens[i].startswith("(?") and tokens[i].endswith(")")):
            depth += 1
        elif tokens[i] == ")":
            depth -= 1
            if depth == 0:
                return i
    return len(tokens) - 1


def _opening(tokens: list[str], end: int) -> int:
    return next((i for i in range(end) if tokens[i].startswith("(") and _closing(tokens, i) == end), -1)


def _branches(tokens: list[str], start: int, end: int) -> list[tuple[int, int]]:
    out, depth, left = [], 0, start
    for i in range(start, end):
        if tokens[i].startswith("(") and not tokens[i].endswith(")"):
            depth += 1
        elif tokens[i] == ")":
            depth -= 1
        elif tokens[i] == "|" and depth == 0:
            out.append((left, i))
            left = i + 1
    return out + [(left, end)]


def _repeats(tokens: list[str], i: int) -> bool:
    """Is ``tokens[i:]`` a repeat by numbers, of which the lower is above zero?"""
    return tokens[i] == "{" and i + 1 < len(tokens) and tokens[i + 1] in "123456789"


def _starts_with_word(tokens: list[str], i: int, end: int) -> bool:
    """Does every match of ``tokens[i:end]`` begin with an ASCII word character?"""
    if i >= end:
        return False
    group = tokens[i] in ("(", "(?:")
    stop = _closing(tokens, i) if group else i
    if stop + 1 < len(tokens) and tokens[stop + 1] in _OPTIONAL and not _repeats(tokens, stop + 1):
        return False
    if group:
        return all(_starts_with_word(tokens, a, b) for a, b in _branches(tokens, i + 1, stop))
    return _is_word(tokens[i])


def _ends_with_word(tokens: list[str], start: int, i: int) -> bool:
    """Does every match of ``tokens[start:i + 1]`` end with an ASCII word character?"""
    if i < start:
        return False
    if tokens[i] == ")":
        left = _opening(tokens, i)
        return tokens[left] in ("(", "(?:") and all(
            _ends_with_word(tokens, a, b - 1) for a, b in _branches(tokens, left + 1, i))
    return _is_word(tokens[i])


def _char_class(token: str, exact: bool) -> str:
    body = re.sub(r"\\s", lambda _: _SPACE, token)
    if not exact or not token.isascii():
        return body
    if token.startswith("[^"):
        return f"(?:{body}|(?-iu:[{_TURKIC_I}]))"
    return f"(?:(?-iu:(?![{_TURKIC_I}])){body})"  # one atom, as a repeat may follow


def _translate(pattern: str, exact: bool) -> str:
    tokens = _TOKEN.findall(pattern)
    out = []
    for i, token in enumerate(tokens):
        if token == r"\b":
            if not exact and _starts_with_word(tokens, i + 1, len(tokens)):
                out.append(_WORD_START)
            elif not exact and _ends_with_word(tokens, 0, i - 1):
                out.append(_WORD_END)
            else:
                out.append(_BOUNDARY)
        elif token == r"\B":
            out.append(f"(?!{_BOUNDARY})")
        elif token == r"\s":
            out.append(f"[{_SPACE}]")
        elif token == r"\S":
            out.append(f"[^{_SPACE}]")
        elif token == r"\w" and exact:
            out.append(r"[\w\u017F\u212A]")
        elif token == "$":
            out.append(r"\z")
        elif token.startswith("[") and len(token) > 1:
            out.append(_char_class(token, exact))
        elif token in ("i", "I") and exact:
            out.append("(?-iu:[iI])")
        else:
            out.append(token)
    return "".join(out)


def rx(pattern: str) -> str:
    """The Java pattern that accepts what ``pattern`` accepts, for any text."""
    return "(?iud)" + _translate(pattern, exact=True)


def rx_lower(pattern: str) -> str:
    """The cheaper Java pattern for lower-cased texts without ``FOLDING_CHARS``."""
    body = _translate(pattern, exact=False)
    plain = pattern.isascii() and not re.search(r"\[[^\]]*[A-Z][^\]]*\]|\(\?", pattern)
    if not plain:
        return "(?iud)" + body
    lowered = re.sub(r"\\.|\[0-9A-Za-z_\]|[A-Z]", lambda m: m[0].lower() if len(m[0]) == 1 else m[0], body)
    return "(?d)" + lowered


def _literals(tokens: list[str], start: int, end: int) -> tuple[str, ...]:
    """Texts of which every match of ``tokens[start:end]`` holds at least one; empty when none can be named."""
    found: list[str] = []
    for left, right in _branches(tokens, start, end):
        choices, run, i = [], "", left
        while i < right:
            token = tokens[i]
            grouped = token.startswith("(") and not token.endswith(")")
            stop = _closing(tokens, i) if grouped else i
            repeat = tokens[stop + 1] if stop + 1 < right and tokens[stop + 1] in ("+", *_OPTIONAL) else ""
            escaped = len(token) == 2 and token[0] == "\\" and not token[1].isalnum()
            literal = escaped and token.isascii() or len(token) == 1 and (
                token not in ".^$|)[(" if token.isascii() else token.lower() in _FOLD_ALONE)
            if literal and repeat not in _OPTIONAL:
                run += token[-1].lower()
            if repeat or not literal:
                choices, run = [*choices, (run,)], ""
            if token in ("(", "(?:") and repeat not in _OPTIONAL:
                choices.append(_literals(tokens, i + 1, stop))
            i = stop + 1 + bool(repeat)
            if repeat == "{":
                i = next((j for j in range(i, right) if tokens[j] == "}"), right) + 1
            if repeat and i < right and tokens[i] == "?":
                i += 1
        # the longest text is the rarest; of several, the shortest decides
        best = max([*choices, (run,)], key=lambda texts: min(map(len, texts), default=0))
        if not all(best) or not best:
            return ()
        found += best
    return tuple(dict.fromkeys(found))


def required_literals(pattern: str) -> tuple[str, ...]:
    """Lower-case texts of which every match holds at least one; empty when none can be named."""
    tokens = _TOKEN.findall(pattern)
    return _literals(tokens, 0, len(tokens))


def matches_lower(lowered: Column, pattern: str) -> Column:
    """``matches`` for lower-cased texts without ``FOLDING_CHARS``: plain substring tests come before the regex."""
    literals = required_literals(pattern)
    hit = lowered.rlike(rx_lower(pattern))
    if not literals:
        return hit
    return reduce(Column.__or__, [F.contains(lowered, F.lit(x)) for x in literals]) & hit


def plain_words(pattern: str) -> tuple[str, ...] | None:
    r"""The words of a pattern that is only ``\bword\b`` or ``\b(word|word)\b``; None for any other pattern."""
    found = re.fullmatch(r"\\b(?:(\w+)|\((?:\?:)?(\w+(?:\|\w+)*)\))\\b", pattern, re.ASCII)
    return tuple((found[1] or found[2]).lower().split("|")) if found else None


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive regex test. Exact word boundaries are costly; only texts whose folding leaves ASCII need them."""
    if r"\b" not in pattern:
        return text.rlike(rx(pattern))
    return F.when(text.rlike(FOLDING_CHARS), text.rlike(rx(pattern))).otherwise(matches_lower(F.lower(text), pattern))


def first_match(text: Column, pattern: str) -> Column:
    """The leftmost match (case-sensitive), '' when there is none."""
    return F.regexp_extract(text, "(?d)" + _translate(pattern, exact=False), 0)


def squeeze(text: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(text, f"[{_SPACE}]+", " ")


@dataclass(frozen=True)
class Entry:
    """One dictionary row: a text matching ``pattern`` mentions ``skill``."""

    skill: str
    category: str
    pattern: str


@dataclass(frozen=True)
class Rule:
    """One rule: a text matching ``pattern`` gives ``field`` the value ``value``; the lowest priority wins."""

    field: str
    priority: int
    pattern: str
    value: str
