"""MinHash near-duplicates: signatures from two permutations, one of them shifted, banded and verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .order import running
from .tables import text_key, written

SHINGLE = 3
THRESHOLD = 85
#: bands of so many rows: documents at the threshold share no band with a chance of 4 in 100,000
BANDS, ROWS = 32, 8
#: slots that shingles are dealt to; permutations are of these
SLOTS = 1 << 22
#: what the documents of one block hold at most (one document more): words, each document counted as DOCUMENT_WORDS at least
BLOCK_WORDS, DOCUMENT_WORDS = 1 << 20, 1 << 10
SEED = 11


@lru_cache(maxsize=2)
def _permutations(seed: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The permutation that shingles go through first, and all shifts of the second: row s is what slot s has under each."""
    rng = np.random.default_rng(seed)
    first, second = rng.permutation(SLOTS).astype(np.int32), rng.permutation(SLOTS).astype(np.int32)
    shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate((second, second[:coordinates])), coordinates)
    return first, shifted


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, sorted distinct shingle hashes of its rows one after the other, and their ends."""
    for low, part in W.pieces(column):
        words = W.split(part, lower=True)
        counts = words.counts
        per_doc = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
        starts = np.repeat(words.first[:-1] - (np.cumsum(per_doc) - per_doc), per_doc) + np.arange(per_doc.sum())
        lasts = np.minimum(starts + shingle, np.repeat(words.first[1:], per_doc))
        # a sequence shorter than a shingle is no prefix of one: its length is part of the hash
        hashes = W.mixed(W.span_hashes(W.word_hashes(words), starts, lasts) + (lasts - starts).astype(np.uint64))
        row = np.repeat(np.arange(len(part)), per_doc)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        yield low, hashes[new], np.searchsorted(row[new], np.arange(len(part)), side="right")


def signature(hashes: np.ndarray, coordinates: int, seed: int = SEED) -> np.ndarray:
    """Coordinate k is the least value under the second permutation shifted by k of the slots that the first one gives."""
    first, shifted = _permutations(seed, coordinates)
    slots = first[(hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)]
    out = np.full(coordinates, np.iinfo(np.int32).max, np.int32)
    for low in range(0, len(slots), 8192):
        np.minimum(out, shifted[slots[low:low + 8192]].min(axis=0), out=out)
    return out


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; bands never share a key but by chance."""
    keys = np.zeros((len(signatures), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(rows):
        keys = W.mixed(keys ^ signatures[:, r::rows].astype(np.uint64)) + np.uint64(r + 1)
    return keys


def signed(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, key, n_shingles, s1, s2, bands)`` per row: the set's size, 128 bits that tell sets apart, and its band keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, keys, sums = np.zeros(batch.num_rows, np.int64), [], []
            for low, hashes, ends in shingle_sets(batch.column("text"), shingle):
                begins = np.concatenate(([0], ends[:-1]))
                size[low:low + len(ends)] = ends - begins
                both = [np.concatenate(([np.uint64(0)], np.cumsum(W.mixed(hashes ^ np.uint64(k))))) for k in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                sums.append(np.stack([b[ends] - b[begins] for b in both], 1))
                signs = np.array([signature(hashes[a:b], bands * rows) for a, b in zip(begins.tolist(), ends.tolist())], np.int32)
                keys.append(_band_keys(signs.reshape(-1, bands * rows), bands, rows))
            sets = np.concatenate(sums) if sums else np.zeros((0, 2), np.uint64)
            raw = [k.tobytes() for part in keys for k in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(size), *[pa.array(sets[:, i].copy().view(np.int64)) for i in (0, 1)],
                 pa.array(raw, pa.binary())], ["doc_id", "key", "n_shingles", "s1", "s2", "bands"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, key long, n_shingles long, s1 long, s2 long, bands binary")


def _buckets(distinct: DataFrame) -> DataFrame:
    """``(band, sid)`` for every band of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid = batch.column("sid").to_numpy(zero_copy_only=False)
            if len(sid):
                keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(sid, len(keys) // len(sid)))], ["band", "sid"])
    return distinct.select("sid", "bands").mapInArrow(run, "band long, sid long")


def _families(distinct: DataFrame) -> DataFrame:
    """``(node, root)`` of the sets that share a band with another, directly or over others."""
    buckets = _buckets(distinct)
    shared = buckets.groupBy("band").agg(F.min("sid").alias("hub"), F.max("sid").alias("most")).where("hub <> most")
    links = buckets.join(shared, "band").where("sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
    return components(links)


def _blocks(members: DataFrame) -> DataFrame:
    """``(sid, family, n_shingles, block)``: families cut, in order of set size, into blocks of bounded work."""
    placed = running(members.withColumn("work", F.greatest("n_shingles", F.lit(DOCUMENT_WORDS))), ["family", "n_shingles", "sid"],
                     sums=["work"], keep=["family", "sid", "n_shingles", "work"], name="blocks")
    start = placed.groupBy("family").agg(F.min(F.col("work_upto") - F.col("work")).alias("start"))
    return placed.join(start, "family").select(
        "sid", "family", "n_shingles", F.floor((F.col("work_upto") - F.col("work") - F.col("start")) / BLOCK_WORDS).alias("block"))


def _pairs_of_blocks(cut: DataFrame, threshold: int) -> DataFrame:
    """``(family, block, one, other)``: each block with every pair of blocks it is compared in, itself included.

    Blocks are in order of set size, so a block meets only those whose least set is not too large for its largest.
    """
    sizes = cut.groupBy("family", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    ahead = sizes.select("family", F.col("block").alias("other"), F.col("low").alias("next_low"))
    near = (F.col("other") >= F.col("block")) & (F.col("next_low") * threshold <= F.col("high") * 100)
    pairs = sizes.join(ahead, "family").where(near).select("family", F.col("block").alias("one"), "other")
    both = F.when(F.col("one") == F.col("other"), F.array("one")).otherwise(F.array("one", "other"))
    return pairs.select("family", F.explode(both).alias("block"), "one", "other")


def _verify(shingle: int, threshold: int):
    """A spanning forest of the links in one pair of blocks; pairs that share no band are no candidates."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        one, other = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        sid = table.column("sid").to_numpy()
        first = table.column("block").to_numpy() == one
        text, sets = table.column("text").combine_chunks(), []
        for _, hashes, ends in shingle_sets(text, shingle):
            sets += np.split(hashes, ends[:-1])
        keys = np.frombuffer(b"".join(table.column("bands").to_pylist()), np.uint64).reshape(len(sid), -1)
        flat, found = np.unique(np.concatenate(sets), return_inverse=True)
        size = np.array([len(s) for s in sets])
        end = np.cumsum(size)
        mark, label, edges = np.zeros(len(flat), bool), np.arange(len(sid)), []
        # small sets first; each is held against those that no link has joined to it yet
        for i in np.lexsort((sid, size)).tolist():
            near = (keys == keys[i]).any(axis=1) & (label != label[i])
            near &= (np.minimum(size, size[i]) * 100 >= threshold * np.maximum(size, size[i]))
            if one != other:
                near &= first != first[i]
            near = np.flatnonzero(near)
            if not len(near):
                continue
            own = found[end[i] - size[i]:end[i]]
            mark[own] = True
            some = np.concatenate([found[end[j] - size[j]:end[j]] for j in near.tolist()])
            both = np.add.reduceat(mark[some].astype(np.int64), np.cumsum(size[near]) - size[near])
            mark[own] = False
            for j in near[both * 100 >= threshold * (size[near] + size[i] - both)].tolist():
                if label[j] != label[i]:
                    edges.append((int(sid[i]), int(sid[j])))
                    label[label == label[j]] = label[i]
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})
    return run


def links(docs: DataFrame, distinct: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Edges ``(a, b)`` of set numbers that connect all sets which share a band and are similar enough, checked on full sets.

    Sets that share bands form families. A family is cut into blocks of bounded size, and every pair of its blocks is one
    group, which returns a spanning forest of the links it finds: n near copies give n - 1 edges, not all pairs.
    """
    members = distinct.join(_families(distinct), F.col("sid") == F.col("node")).select(
        "sid", F.col("root").alias("family"), "n_shingles", "bands", "lead")
    members = written(members, "members")
    cut = written(_blocks(members.select("sid", "family", "n_shingles")), "cut")
    sent = cut.select("sid", "family", "block").join(_pairs_of_blocks(cut, threshold), ["family", "block"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    led = members.select("sid", "bands", F.col("lead.doc_id").alias("lead_id"), F.col("lead.key").alias("lead_key"))
    same = F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("key") == F.col("lead_key"))
    # one text for each set: rows that are the same in id and text come once
    known = written(texts.join(led, same).select("sid", "bands", "text").dropDuplicates(["sid"]), "texts")
    groups = sent.join(known, "sid").groupBy("family", "one", "other")
    return groups.applyInArrow(_verify(shingle, threshold), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Documents are linked if 100 times the intersection of their shingle sets is at least ``threshold`` times the union.
    ``component_id`` is the smallest doc_id reachable over links, itself included; null ids are passed over (null if there
    is no other). ``kept`` holds where that is the row's own id. Null texts and texts without words have an empty
    set, which is linked with nothing, not even its like; a text of fewer words than a shingle is one shingle.
    Repeated rows keep their number and are linked to each other. Other columns play no part. Empty in, empty out.
    """
    every = written(signed(docs, shingle, bands, rows), "signed")
    grouped = every.where("n_shingles > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("lead"),
        F.max("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    distinct = written(grouped.withColumn("sid", F.monotonically_increasing_id()), "distinct")
    roots = components(links(docs, distinct, shingle, threshold))
    linked = written(distinct.select("sid", "least").join(roots, F.col("sid") == F.col("node")).drop("node"), "linked")
    by_root = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    known = linked.select("sid", "root").join(by_root, "root").select("sid", "component_id")
    named = distinct.select("s1", "s2", "sid", "least").join(known, "sid", "left").select(
        "s1", "s2", F.when(F.col("sid").isNotNull() & F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    full = every.where("n_shingles > 0").select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"]).select(
        "doc_id", "n_shingles", "component_id")
    alone = every.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = full.union(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
