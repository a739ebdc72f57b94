"""Quality rules: fixed limits, then boosted trees over statistics of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .boosting import Trees, fit
from .tables import fresh, of_small_hash, written

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: features of the trees; scores may only fall with the last three
FEATURES = ["word_length", "upper", "digits", "marks", "words_per_line", "distinct",
            "symbols", "dup_lines", "repeat_words"]
MONOTONIC = {6: -1, 7: -1, 8: -1}
LEAST_WORDS, MOST_REPEAT_PERCENT = 50, 50
#: labelled rows that the trees are fitted on, at most; chosen by hash of the id
TRAIN_ROWS = 20_000
#: least probability of good quality at which a document is kept
KEEP_FROM = 0.5

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CLASSES = {"n_symbols": _SYMBOLS, "n_upper": np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            "n_digits": np.isin(np.arange(256), list(b"0123456789")), "n_marks": np.isin(np.arange(256), list(b"!?"))}


def _repeated(words: W.Words, values: np.ndarray) -> np.ndarray:
    """Words in 3-word windows that occur twice or more in their document; equal hashes are compared word for word."""
    starts = W.window_starts(words.first, 3)
    doc = np.searchsorted(words.first, starts, side="right") - 1
    hashes = W.span_hashes(values, starts, starts + 3)
    order = np.lexsort((hashes, doc))
    same = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again = np.flatnonzero(same)
    a, b = starts[order[again]], starts[order[again + 1]]
    text, s, e = words.text, words.start, words.end
    equal = np.fromiter((text[i:j] == text[k:m] for i, j, k, m in zip(
        s[a].tolist(), e[a + 2].tolist(), s[b].tolist(), e[b + 2].tolist())), bool, len(a))
    found = W.covered(np.unique(np.concatenate([a[equal], b[equal]])), 3, len(s))
    sums = np.concatenate(([0], np.cumsum(found)))
    return np.diff(sums[words.first])


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of every text of a column, by name; all 0 for null and empty texts."""
    found: dict[str, list[np.ndarray]] = {n: [np.zeros(0, np.int64)] for n in COUNTS + MORE}
    for _, part in W.pieces(column):
        data, offsets = W.utf8(part)
        words = W.split(part)
        values = W.word_hashes(words)
        own = {n: _per_doc(c[data], offsets) for n, c in _CLASSES.items()}
        own["n_words"] = words.counts
        own["word_chars"] = _per_doc(W.NOT_SPACE[data] & ((data & 0xC0) != 0x80), offsets)
        own["n_repeat_words"] = _repeated(words, values)
        doc = np.repeat(np.arange(len(part)), words.counts)
        order = np.lexsort((values, doc))
        new = np.ones(len(order), bool)
        new[1:] = (values[order][1:] != values[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        own["n_distinct"] = np.bincount(doc[order][new], minlength=len(part))
        lines, dup = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        raw = data.tobytes()
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            worded = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\n\v\f\r")]
            lines[i], dup[i] = len(worded), len(worded) - len(set(worded))
        own["n_lines"], own["n_dup_lines"] = lines, dup
        for n, v in own.items():
            found[n].append(v)
    return {n: np.concatenate(v) for n, v in found.items()}


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """A row of FEATURES per document, from its counts."""
    n, chars, lines = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["n_lines"], 1)
    return np.stack([s["word_chars"] / n, s["n_upper"] / chars, s["n_digits"] / chars,
                     s["n_marks"] / n, s["n_words"] / lines, s["n_distinct"] / n, s["n_symbols"] / chars,
                     s["n_dup_lines"] / lines, s["n_repeat_words"] / n], axis=1)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEAT_PERCENT * s["n_words"])


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of ``statistics`` for every row. No shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(s[n], pa.int64()) for n in COUNTS + MORE)], ["doc_id", *COUNTS, *MORE])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in COUNTS + MORE))


def train(counts: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``labels(doc_id, quality)``, fitted on at most ``rows`` labelled documents, those of the smallest hash.

    Null ids and labels, and labels of unknown documents, are passed over. An id counts once, however often it is labelled and
    documented: with the lower label and the least of its rows of counts. Without labels of both kinds the score is constant.
    """
    known = (labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    known = of_small_hash(known, "doc_id", rows)
    once = counts.join(known, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct(*COUNTS, *MORE)).alias("counts"), F.min("quality").alias("quality"))
    sample = once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("counts.*", "quality").collect()
    s = {n: np.array([r[n] for r in sample], np.int64) for n in COUNTS + MORE}
    return fit(features(s), np.array([r["quality"] for r in sample], float), MONOTONIC)


def judged(counts: DataFrame, trees: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """``counts`` with ``base_failed``, ``score`` (probability of good quality) and ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = {n: batch.column(n).to_numpy() for n in COUNTS + MORE}
            failed, score = base_failed(s), trees.probability(features(s))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep_from))],
                [*batch.schema.names, "base_failed", "score", "kept"])

    kinds = ", ".join(f"{n} {t}" for n, t in counts.dtypes)
    return counts.mapInArrow(run, f"{kinds}, base_failed boolean, score double, kept boolean")


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The verdict on every row of ``docs(doc_id, text)``; null and empty texts fail. Texts are read once."""
    counts = written(counted(docs), "counts")
    return judged(counts, train(counts, labels))


def kept(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Counts are taken anew for the verdict, so no text is shuffled."""
    trees = train(counted(docs), labels)
    body = fresh(docs, "body")
    given = docs.withColumn(body, F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column(batch.num_columns - 1))
            good = ~base_failed(s) & (trees.probability(features(s)) >= keep_from)
            own = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
            yield own.filter(pa.array(good))

    return given.mapInArrow(run, docs.schema)
