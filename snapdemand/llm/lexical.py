"""Ranked lexical search: sketches of coordinatewise maxima bound every score, exact rescoring goes down from the highest."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import written

TOP = 10
#: coordinates of a sketch; terms are dealt to them by hash
COORDINATES = 512
#: the largest frequency that a coordinate tells; it stands for any frequency from there on
MANY = 255
#: queries of one block, and the bytes of their texts (one query more)
BLOCK_QUERIES, BLOCK_BYTES = 1024, 1 << 22
#: documents bounded at once, and candidates of one query rescored at once
BATCH, STEP = 1024, 64


def _terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, sorted distinct term hashes of its rows, their frequencies, and ends of rows."""
    for low, part in W.pieces(column):
        words = W.split(part, W.ALPHANUMERIC, lower=True)
        hashes, row = W.word_hashes(words), np.repeat(np.arange(len(part)), words.counts)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        begins = np.flatnonzero(new)
        yield low, hashes[new], np.diff(np.append(begins, len(hashes))), np.searchsorted(row[new], np.arange(len(part)), side="right")


def index(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, sketch, terms, frequencies)`` of every row of ``docs``, written once.

    ``sketch`` has, for each coordinate, the largest frequency of the terms dealt to it. A term's impact rises with its
    frequency, so that is the largest impact too, whatever the collection's size and mean length turn out to be.
    ``terms`` are the sorted hashes of the distinct terms. Null and empty texts have none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sketches, terms, frequencies = [], [], [], []
            for _, hashes, often, ends in _terms(batch.column("text")):
                rows = len(ends)
                begins = np.concatenate(([0], ends[:-1]))
                row = np.repeat(np.arange(rows), ends - begins)
                sketch = np.zeros((rows, COORDINATES), np.uint8)
                np.maximum.at(sketch, (row, (hashes % np.uint64(COORDINATES)).astype(np.int64)), np.minimum(often, MANY).astype(np.uint8))
                n.append(np.bincount(row, often, rows).astype(np.int64))
                sketches += [s.tobytes() for s in sketch]
                terms += [hashes[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
                frequencies += [often[a:b].astype(np.int32).tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(n) if n else [], pa.int64()),
                 *[pa.array(x, pa.binary()) for x in (sketches, terms, frequencies)]],
                ["doc_id", "n", "sketch", "terms", "frequencies"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(given.mapInArrow(run, "doc_id long, n long, sketch binary, terms binary, frequencies binary"), "sketches")


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row of every posting of a batch of the index, and its term."""
    raw = batch.column("terms").to_pylist()
    return np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw]), np.frombuffer(b"".join(raw), np.uint64)


def _among(vocabulary: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the terms that are in the sorted vocabulary, and where they are there."""
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    found = np.flatnonzero(vocabulary[at] == terms)
    return found, at[found]


@dataclass
class _Block:
    """Queries as rows of (vocabulary number, times): query q has those from ``first[q]`` to ``first[q + 1]``."""

    ids: list
    vocabulary: np.ndarray
    term: np.ndarray
    times: np.ndarray
    first: np.ndarray
    weight: np.ndarray | None = None


def _blocks(queries: DataFrame) -> Iterator[_Block]:
    """Blocks of queries, fetched one after the other; queries without a term have no answer and are left out."""
    rows, size = [], 0

    def block() -> _Block:
        terms, times, first = [], [], [np.zeros(1, np.int64)]
        for _, hashes, often, ends in _terms(pa.array([r["text"] for r in rows], pa.string())):
            terms.append(hashes)
            times.append(often)
            first.append(first[-1][-1] + ends)
        vocabulary, term = np.unique(np.concatenate(terms), return_inverse=True)
        return _Block([r["item_id"] for r in rows], vocabulary, term, np.concatenate(times), np.concatenate(first))

    for r in queries.toLocalIterator():
        rows.append(r)
        size += len(r["text"])
        if len(rows) == BLOCK_QUERIES or size >= BLOCK_BYTES:
            yield block()
            rows, size = [], 0
    if rows:
        yield block()


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    return 25 + 75 * n * documents // total


def _document_frequencies(indexed: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of a block's vocabulary, counted over all rows of the index."""
    sent = indexed.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            have += np.bincount(_among(sent.value, _postings(batch)[1])[1], minlength=len(have))
        some = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(have[some])], ["term", "df"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in indexed.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    sent.unpersist()
    return out


def _search(block: _Block, documents: int, total: int, top: int):
    """The best ``top`` documents of a task for every query: bounds for batches of documents, then exact scores from the
    highest bound on until none is left that reaches the lowest of the best so far.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = block.value
        queries, size = len(q.ids), len(q.vocabulary)
        per_query = q.weight[q.term] * q.times
        folded = np.zeros((COORDINATES, queries))
        np.add.at(folded, ((q.vocabulary[q.term] % np.uint64(COORDINATES)).astype(np.int64), np.repeat(np.arange(queries), np.diff(q.first))), per_query)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * queries
        least = np.ones(queries)
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH):
                batch = whole.slice(low, BATCH)
                m = _lengths(batch.column("n").to_numpy(), documents, total)
                ids = batch.column("doc_id")
                unnamed, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES).astype(np.int64)
                # below 2**53, so exact: no document's bound is under its score
                bounds = np.where(sketch == MANY, 1_000_000, _impact(sketch, m[:, None])).astype(np.float64) @ folded
                row, terms = _postings(batch)
                found, at = _among(q.vocabulary, terms)
                keys = row[found] * size + at
                tf = np.frombuffer(b"".join(batch.column("frequencies").to_pylist()), np.int32)[found].astype(np.int64)
                impacts = np.append(_impact(tf, m[row[found]]), 0)
                keys = np.append(keys, np.iinfo(np.int64).max)
                for k in np.flatnonzero((bounds >= least).any(axis=0)).tolist():
                    bound = bounds[:, k]
                    order = np.flatnonzero(bound >= least[k])
                    order = order[np.argsort(-bound[order], kind="stable")]
                    own, weights = q.term[q.first[k]:q.first[k + 1]], per_query[q.first[k]:q.first[k + 1]]
                    for step in range(0, len(order), STEP):
                        some = order[step:step + STEP]
                        some = some[bound[some] >= least[k]]
                        if not len(some):
                            break
                        wanted = some[:, None] * size + own[None, :]
                        place = np.searchsorted(keys, wanted)
                        scores = (np.where(keys[place] == wanted, impacts[place], 0) * weights).sum(axis=1)
                        good = scores >= least[k]
                        kept = [np.concatenate(x) for x in zip(best[k], (scores[good], ids[some[good]], unnamed[some[good]]))]
                        first = np.lexsort((kept[1], kept[2], -kept[0]))[:top]
                        best[k] = tuple(x[first] for x in kept)
                        if len(first) == top:
                            least[k] = best[k][0][-1]
        n = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(queries), n)), pa.array(np.concatenate([b[1] for b in best]), mask=np.concatenate([b[2] for b in best])),
             pa.array(np.concatenate([b[0] for b in best]))], ["query", "doc_id", "score"])
    return run


def search(indexed: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of highest score above 0 for each query, all if fewer.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))) for N documents with any term, df of them with this one; a
    document's score adds weight times impact for each term of the query, repeats included. Equal scores are ranked by
    ascending doc_id (null last). Every row of the index is a document, repeated ids included. Queries without terms have
    no rows; rows of ``queries`` that are the same in id and text are one query, ids with several texts have each
    text's ranks. Queries go to the tasks in blocks, one after the other; each is held against all rows.
    """
    spark = indexed.sparkSession
    documents, total = indexed.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    asked = queries.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    kind = dict(queries.dtypes)["item_id"]
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in _blocks(asked) if documents else ():
        if not len(block.vocabulary):
            continue
        df = _document_frequencies(indexed, block.vocabulary)
        block.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        sent = spark.sparkContext.broadcast(block)
        found = indexed.where("n > 0").mapInArrow(_search(sent, documents, total, top), "query long, doc_id long, score long")
        first = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query long, item_id {kind}")
        out = out.union(written(first.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked"))
        sent.unpersist()
    return out
