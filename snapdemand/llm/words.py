"""Words of many texts at once, as numpy offsets into one UTF-8 buffer.

All word patterns used here are classes of ASCII bytes and their complement, so they can be decided byte by byte; bytes
of longer code points are word bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ALL = np.arange(256)
#: bytes of words ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, lower-case letters, all beyond ASCII
ALPHANUMERIC = ~((_ALL <= 0x2F) | ((_ALL >= 0x3A) & (_ALL <= 0x60)) | ((_ALL >= 0x7B) & (_ALL <= 0x7F)))
_LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass
class Words:
    """``text`` holds the words of every document joined by one space, documents without anything between them.

    Word i is ``text[start[i]:end[i]]``; document d has the words ``first[d]`` to ``first[d + 1]``.
    """

    text: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, size: int = 1 << 21) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column of about ``size`` bytes, so that arrays made from them stay small; one row at least."""
    lengths = np.diff(utf8(column)[1])
    low, have = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if have and have + n > size:
            yield low, column.slice(low, i - low)
            low, have = i, 0
        have += n
    if low < len(column):
        yield low, column.slice(low)


def split(column: pa.Array, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = _LOWER[data]
    if not data.size:
        none = np.zeros(0, np.int64)
        return Words(b"", none, none, np.zeros(len(offsets), np.int64))
    inside = word_bytes[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < data.size)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    # the byte after a word becomes the space between it and the next; a document's last word has none
    gap = np.ones(len(end), bool)
    gap[first[1:][np.diff(first) > 0] - 1] = False
    kept = inside.copy()
    kept[end[gap]] = True
    text = data.copy()
    text[end[gap]] = 0x20
    # what is left out before a word moves it to the left; documents' last words have no space behind them
    lengths = end - start
    new_end = np.cumsum(lengths + gap) - gap
    return Words(text[kept].tobytes(), new_end - lengths, new_end, first)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_ODD, _ODD_INVERSE)):
            values = np.full(max(n, 1 << 20), base)
            values[0] = 1
            _powers[k] = np.cumprod(values)
    return _powers


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each span: a polynomial in an odd number modulo 2**64, by prefix sums."""
    power, inverse = _powers_to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * power[:len(values)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * inverse[start])


def word_hashes(words: Words, size: int = 1 << 19) -> np.ndarray:
    """Hash of every word; bytes are taken ``size`` at a time, as a hash doesn't depend on the place."""
    text, out, low = np.frombuffer(words.text, np.uint8), np.zeros(len(words.start), np.uint64), 0
    while low < len(out):
        high = max(low + 1, int(np.searchsorted(words.end, words.start[low] + size, side="right")))
        a, b = words.start[low], words.end[high - 1]
        out[low:high] = span_hashes(text[a:b] + np.uint64(1), words.start[low:high] - a, words.end[low:high] - a)
        low = high
    return out


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Index of every word that starts a window of ``length`` words within its document."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return base + np.arange(counts.sum())


def covered(starts: np.ndarray, length, size: int) -> np.ndarray:
    """Flags of the words inside any span ``[start, start + length)``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0
