"""Substring dedup: words covered by a window of words that also starts somewhere else in the corpus go."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import text_key, written

WINDOW = 35
#: words of a minimiser
MINIMISER = 3
#: bytes of packed strings that one bucket holds on average
BUCKET_BYTES = 8 << 20
#: a minimiser of so many super-k-mers or more is hot: its windows are dealt one by one. At most MAX_HOT, the hottest.
HOT_FROM = 1 << 16
MAX_HOT = 1 << 20
#: bytes of packed strings per byte of text, about
_BLOW_UP = 3
_LEVEL = 3
#: bytes of strings that a task gathers before it sends them
SENT_BYTES = 24 << 20


def _least(values: np.ndarray, length: int) -> np.ndarray:
    """Position of the first smallest of ``length`` values from each position on, by doubling."""
    at, have = np.arange(len(values)), 1
    while have < length:
        step = min(have, length - have)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def super_kmers(words: W.Words, window: int, m: int, hot: np.ndarray):
    """First word, number of windows and bucket hash of every super-k-mer.

    The minimiser of a window is the first of its m-word grams with the smallest hash. Consecutive windows that share it,
    by place, form one super-k-mer. So a window's words decide on its minimiser and its place in the window, and equal
    windows meet in one bucket. Windows of a hot minimiser are super-k-mers of their own, dealt by their whole words.
    """
    starts = W.window_starts(words.first, window)
    if not len(starts):
        return starts, starts, starts.astype(np.uint64)
    values, grams = W.word_hashes(words), np.arange(len(words.start) - m + 1)
    hashes = W.span_hashes(values, grams, grams + m)
    at = _least(hashes, window - m + 1)[starts]
    begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.concatenate((begin, [len(starts)])))
    bucket = hashes[at[begin]]
    if len(hot):
        single = np.repeat(np.isin(bucket, hot), n)
        whole = np.concatenate(([True], at[1:] != at[:-1])) | single
        begin = np.flatnonzero(whole)
        n = np.diff(np.concatenate((begin, [len(starts)])))
        bucket = hashes[at[begin]]
        own = single[begin]
        bucket[own] = W.span_hashes(values, starts[begin[own]], starts[begin[own]] + window)
    return starts[begin], n, bucket


def _strings(words: W.Words, first: np.ndarray, n: np.ndarray, window: int) -> list[bytes]:
    text = words.text
    return [text[a:b] for a, b in zip(words.start[first].tolist(), words.end[first + n + window - 2].tolist())]


def _count(window: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [super_kmers(W.split(p), window, m, np.zeros(0, np.uint64))[2] for _, p in W.pieces(batch.column("text"))]
            if found:
                minimisers, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(minimisers.view(np.int64)), pa.array(n)], ["minimiser", "n"])
    return run


def _send(window: int, m: int, buckets: int, hot: np.ndarray):
    """Super-k-mers to their buckets: per so many bytes and bucket one compressed value with each different string once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=_LEVEL)
        found: dict[bytes, int] = {}
        again: set[bytes] = set()
        size = 0
        for batch in batches:
            for _, part in W.pieces(batch.column("text")):
                words = W.split(part)
                first, n, bucket = super_kmers(words, window, m, hot)
                for s, b in zip(_strings(words, first, n, window), (bucket % np.uint64(buckets)).tolist()):
                    if s in found:
                        again.add(s)
                    else:
                        found[s] = b
                        size += len(s)
                if size > SENT_BYTES:
                    yield from _packed(found, again, packer)
                    found, again, size = {}, set(), 0
        yield from _packed(found, again, packer)
    return run


def _packed(found: dict[bytes, int], again: set[bytes], packer) -> Iterator[pa.RecordBatch]:
    by_bucket: dict[int, list[bytes]] = {}
    for s, b in found.items():
        by_bucket.setdefault(b, []).append(s)
    values = [packer.compress(b"".join(b"2" if s in again else b"1" for s in own) + b"\n" + b"\n".join(own))
              for own in by_bucket.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(by_bucket), pa.int64()), pa.array(values, pa.binary())], ["bucket", "packed"])


def key_of(strings: list[bytes]) -> np.ndarray:
    """128-bit keys of strings, as two longs each."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.int64).reshape(-1, 2)


def repeated_windows(strings: list[bytes], twice: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that occur again: number of the string, first window, number of windows.

    ``strings`` differ; those marked ``twice`` occur more than once. Windows are sorted by hash, and those of equal hash
    are compared word for word, so the counts are exact.
    """
    words = W.split(pa.array(strings, pa.large_binary()))
    starts = W.window_starts(words.first, window)
    owner = np.searchsorted(words.first, starts, side="right") - 1
    hashes = W.span_hashes(W.word_hashes(words), starts, starts + window)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    flags = twice[owner].copy()
    text, begin, end = words.text, words.start[starts], words.end[starts + window - 1]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    for low, high in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist()):
        seen: dict[bytes, int] = {}
        for i in order[low:high].tolist():
            other = seen.setdefault(text[begin[i]:end[i]], i)
            if other != i:
                flags[other] = flags[i] = True
    # runs of flagged windows within one string
    edge = np.ones(len(flags) + 1, bool)
    edge[1:-1] = (flags[1:] != flags[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(edge)
    keep = flags[at[:-1]] if len(flags) else np.zeros(0, bool)
    low, n = at[:-1][keep], np.diff(at)[keep]
    return owner[low], starts[low] - words.first[owner[low]], n


def _judge(window: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        unpacker, times = zstandard.ZstdDecompressor(), {}
        for value in rows["packed"]:
            flags, _, joined = unpacker.decompress(value).partition(b"\n")
            for s, n in zip(joined.split(b"\n"), flags):
                times[s] = n == 50 or s in times
        strings = list(times)
        owner, first, n = repeated_windows(strings, np.fromiter(times.values(), bool, len(times)), window)
        keys = key_of([strings[i] for i in owner.tolist()])
        return pd.DataFrame({"k1": keys[:, 0], "k2": keys[:, 1], "first": first.astype(np.int32), "n": n.astype(np.int32)})
    return run


def _places(window: int, m: int, hot: np.ndarray):
    """Key of every super-k-mer, and where it starts in its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, part in W.pieces(batch.column("text")):
                words = W.split(part)
                first, n, _ = super_kmers(words, window, m, hot)
                doc = np.searchsorted(words.first, first, side="right") - 1
                keys, rows = key_of(_strings(words, first, n, window)), pa.array(low + doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column("doc_id").take(rows), batch.column("key").take(rows),
                     pa.array((first - words.first[doc]).astype(np.int32))], ["k1", "k2", "doc_id", "key", "place"])
    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=_LEVEL)
    for batch in batches:
        packed = [packer.compress(t) for t in batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(packed, pa.binary())],
                                         ["doc_id", "key", "packed"])


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = pa.array([unpacker.decompress(p) for p in batch.column("packed").to_pylist()], pa.large_binary())
            counts, removed, sums, kept = [], [], [], []
            spans, at = batch.column("spans"), 0
            for low, part in W.pieces(texts):
                words = W.split(part)
                gone = spans.slice(low, len(part)).to_pylist()
                starts = np.fromiter(chain.from_iterable(
                    (f + s["start"] for s in g) for f, g in zip(words.first.tolist(), gone) if g), np.int64)
                n = np.fromiter(chain.from_iterable((s["n"] for s in g) for g in gone if g), np.int64)
                out = W.covered(starts, n + window - 1, len(words.start))
                for d, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                    if gone[d]:
                        left = (a + np.flatnonzero(~out[a:b])).tolist()
                        text = b" ".join([words.text[words.start[i]:words.end[i]] for i in left])
                    else:
                        left, text = range(a, b), words.text[words.start[a]:words.end[b - 1]] if b > a else b""
                    counts.append(b - a)
                    removed.append(b - a - len(left))
                    sums.append(hashlib.sha256(text).hexdigest())
                    kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(sums, pa.string()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, m: int = MINIMISER, bucket_bytes: int = BUCKET_BYTES,
                    hot_from: int = HOT_FROM) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, kept)`` for every row of ``docs(doc_id, text)``.

    Words are runs without white space. Each word inside a window of ``window`` consecutive words that also starts
    anywhere else goes; all windows are judged on the input. ``kept`` are the other words, joined by one space. Null,
    empty and short texts lose nothing; a row that is there twice loses all its windows.

    One super-k-mer's windows travel as one string; a task sends each different string once, so copies of a document cost a
    string per task. The number of buckets follows the text. Hot minimisers are counted first, with partial sums,
    and their windows spread over all buckets; the list of them is bounded. Answers return as runs of windows per string,
    found again by its 128-bit key, then per document; that join's many sides may be split where a key is hot.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"),
                       F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(spark.sparkContext.defaultParallelism, math.ceil(size * _BLOW_UP / bucket_bytes))
    counts = rows.select("text").mapInArrow(_count(window, m), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    hottest = counts.where(F.col("n") >= hot_from).orderBy(F.desc("n"), "minimiser").limit(MAX_HOT).collect()
    hot = np.sort(np.array([r["minimiser"] for r in hottest], np.int64).view(np.uint64))

    sent = rows.select("text").mapInArrow(_send(window, m, buckets, hot), "bucket long, packed binary")
    answers = written(sent.groupBy("bucket").applyInPandas(_judge(window), "k1 long, k2 long, first int, n int"), "answers")
    places = rows.mapInArrow(_places(window, m, hot), "k1 long, k2 long, doc_id long, key long, place int")
    spans = (
        places.join(answers, ["k1", "k2"])
        .groupBy("doc_id", "key").agg(F.collect_set(F.struct((F.col("place") + F.col("first")).alias("start"), "n")).alias("spans"))
        .select(F.col("doc_id").alias("own_id"), F.col("key").alias("own_key"), "spans"))
    texts = rows.mapInArrow(_compress, "doc_id long, key long, packed binary")
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("key").eqNullSafe(F.col("own_key"))
    return texts.join(spans, same, "left").select("doc_id", "packed", "spans").mapInArrow(
        _remove(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
