"""Benchmark decontamination: winnowed fingerprints find shared passages, extension gives their exact words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import fresh

WINDOW = 10
GRAM = 5
#: bytes of benchmark text that are sent to the tasks at once; larger benchmarks are taken in several blocks
BLOCK_BYTES = 8 << 20


def winnow(hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Positions of the last smallest hash in every run of ``window`` hashes of one document."""
    starts = W.window_starts(first, window)
    if not len(starts):
        return starts
    least, at = hashes[starts], starts.copy()
    for i in range(1, window):
        other = hashes[starts + i]
        smaller = other <= least
        least[smaller] = other[smaller]
        at[smaller] = starts[smaller] + i
    return np.unique(at)


def _grams(values: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and per-document offsets of all grams of ``length`` words."""
    starts = W.window_starts(first, length)
    hashes = W.span_hashes(values, starts, starts + length)
    return starts, hashes, np.concatenate(([0], np.cumsum(np.maximum(np.diff(first) - length + 1, 0))))


@dataclass
class Windows:
    """The different windows of one length: their sorted hashes, where their words stand in the block's text, and their items.

    Window i is ``text[start[i]:end[i]]`` and occurs in the items ``items[first[i]:first[i + 1]]``, each named once.
    """

    length: int
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    items: np.ndarray

    def found(self, words: W.Words, values: np.ndarray, starts: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``starts`` where a document has a window, word for word, and the windows' numbers."""
        if not len(starts) or not len(self.hashes):
            return starts[:0], starts[:0]
        own = W.span_hashes(values, starts, starts + self.length)
        at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
        same = np.flatnonzero(self.hashes[at] == own)
        starts, at = starts[same], at[same]
        equal = [words.text[a:b] == text[c:d] for a, b, c, d in zip(
            words.start[starts].tolist(), words.end[starts + self.length - 1].tolist(), self.start[at].tolist(), self.end[at].tolist())]
        equal = np.array(equal, bool)
        return starts[equal], at[equal]


@dataclass
class Block:
    """Items of a benchmark: their text, the sorted fingerprints of their windows, and the windows by length."""

    ids: list[str]
    text: bytes
    hashes: np.ndarray
    windows: list[Windows]


def _windows(words: W.Words, values: np.ndarray, starts: np.ndarray, length: int) -> Windows:
    item = np.searchsorted(words.first, starts, side="right") - 1
    hashes = W.span_hashes(values, starts, starts + length)
    order = np.lexsort((item, hashes))
    hashes, item, starts = hashes[order], item[order], starts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    once = new.copy()
    once[1:] |= item[1:] != item[:-1]
    of = (np.cumsum(new) - 1)[once]
    return Windows(length, hashes[new], words.start[starts[new]], words.end[starts[new] + length - 1],
                   np.searchsorted(of, np.arange(new.sum() + 1)), item[once])


def _block(rows: list, window: int, gram: int) -> Block:
    words = W.split(pa.array([r["text"] for r in rows], pa.string()), W.ALPHANUMERIC, lower=True)
    values, counts = W.word_hashes(words), words.counts
    _, hashes, first = _grams(values, words.first, gram)
    picked = np.unique(hashes[winnow(hashes, first, window - gram + 1)])
    every = [_windows(words, values, W.window_starts(words.first, window), window)]
    for length in sorted(set(counts[(counts > 0) & (counts < window)].tolist())):
        every.append(_windows(words, values, words.first[:-1][counts == length], length))
    return Block([str(r["item_id"]) for r in rows], words.text, picked, every)


def _hits(part: pa.Array, block: Block, window: int, gram: int):
    """Words of a column, which of them are hit, and pairs of document and window found, each pair once.

    A window that a document shares with an item has its smallest gram on both sides. So around each shared fingerprint
    the windows that hold it are looked up; where they follow each other, the hit extends. Each position costs the
    same, however often the document or the benchmark repeats its words.
    """
    words = W.split(part, W.ALPHANUMERIC, lower=True)
    values, size = W.word_hashes(words), len(words.start)
    starts, hashes, first = _grams(values, words.first, gram)
    picked = winnow(hashes, first, window - gram + 1)
    at = starts[picked][np.isin(hashes[picked], block.hashes)]
    doc = np.searchsorted(words.first, at, side="right") - 1
    around = at[:, None] - np.arange(window - gram + 1)[None, :]
    inside = (around >= words.first[doc][:, None]) & (around + window <= words.first[doc + 1][:, None])
    where, lengths, found = [], [], []
    for table in block.windows:
        some = np.unique(around[inside]) if table.length == window else W.window_starts(words.first, table.length)
        hit, number = table.found(words, values, some, block.text)
        where.append(hit)
        lengths.append(np.full(len(hit), table.length))
        pairs = np.unique(np.stack([np.searchsorted(words.first, hit, side="right") - 1, number], 1), axis=0)
        found += [(d, table, n) for d, n in pairs.tolist()]
    hit = W.covered(np.concatenate(where), np.concatenate(lengths), size)
    return words, hit, found


def _blocks(benchmark: DataFrame, size: int) -> Iterator[DataFrame]:
    """The benchmark's rows with a word, in parts of about ``size`` bytes, dealt by hash."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / size))
    for i in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items


def _marker(sent, window: int, gram: int):
    """Adds one block's hits to the last two columns; the third last becomes the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, items = [np.zeros(0, np.int64)], [], []
            for _, part in W.pieces(batch.column(batch.num_columns - 4)):
                words, hit, found = _hits(part, sent.value, window, gram)
                counts.append(words.counts)
                by_doc: dict[int, set[str]] = {}
                for d, table, n in found:
                    ids = sent.value.ids
                    by_doc.setdefault(d, set()).update(ids[i] for i in table.items[table.first[n]:table.first[n + 1]].tolist())
                items += [by_doc.get(d, ()) for d in range(len(part))]
                hits += [np.flatnonzero(hit[words.first[d]:words.first[d + 1]]).tolist() if d in by_doc else ()
                         for d in range(len(part))]
            before = [x.to_pylist() for x in batch.columns[-2:]]
            hits = [sorted({*a, *b}) if a and b else list(a or b) for a, b in zip(before[0], hits)]
            items = [sorted({*a, *b}) for a, b in zip(before[1], items)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(np.concatenate(counts)),
                 pa.array(hits, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], batch.schema.names)
    return run


def marked(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
           block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four more columns behind its own; their names by role: words, n_words, hits and items.

    Every 10 consecutive words of an item are a window, and a shorter item as a whole. A gram of 5 words hashes to one
    value, and of 6 consecutive ones the smallest is kept on both sides, so any shared 10 words share a fingerprint.
    Around equal fingerprints every window is compared word by word; windows that follow each other extend the hit.
    ``hits`` are the positions of hit words, ``items`` the item_ids found as sorted strings. Texts without words, and
    null texts, have none; null items have no words. Repeated rows are judged each.

    The benchmark is a stated query set: it goes to the tasks in blocks of bounded size, one after the other over the same
    rows, each adding its hits. However many blocks there are, no row is shuffled.
    """
    spark, names = docs.sparkSession, {}
    out = docs
    for role, kind in (("body", "string"), ("n_words", "long"), ("hits", "array<long>"), ("items", "array<string>")):
        names[role] = fresh(out, role)
        value = F.col("text").cast("string") if role == "body" else F.lit(0).cast("long") if role == "n_words" else F.array()
        out = out.withColumn(names[role], value.cast(kind))
    for some in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(_block(some.collect(), window, gram))
        out = out.mapInArrow(_marker(sent, window, gram), out.schema)
    return out, names


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_words, n_hit, items, contaminated)`` for every row of ``docs``; see ``marked``."""
    out, names = marked(docs.select("doc_id", "text"), benchmark, **options)
    return out.select("doc_id", F.col(names["n_words"]).alias("n_words"), F.size(names["hits"]).cast("long").alias("n_hit"),
                      F.col(names["items"]).alias("items"), (F.size(names["hits"]) > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any hit, with their own columns; see ``marked``."""
    out, names = marked(docs, benchmark, **options)
    return out.where(F.size(names["hits"]) == 0).select(*docs.columns)
