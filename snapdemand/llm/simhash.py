"""SimHash near-duplicates: fingerprints within a few bits of each other, found by ball hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .tables import fresh, text_key, written

SHINGLE = 4
MAX_BITS = 4
#: fingerprints that one bucket holds in memory, and variants that it sorts at once
BUCKET_FINGERPRINTS = 1 << 20
SORTED_VARIANTS = 1 << 21
#: bit positions that make a bucket: at least, and at most (with all but two, a bucket holds 8,324 fingerprints at most)
MIN_DEPTH = 6
DEEPEST = 62
#: positions by which a bucket that is too full is split at once
SPLIT = 3
#: a fingerprint of more than this share of the rows is joined in so many parts
FREQUENT = 1024
PARTS = 64


def _fingerprint(column: pa.Array, shingle: int) -> np.ndarray:
    out = np.zeros(len(column), np.uint64)
    for low, part in W.pieces(column):
        words = W.split(part, lower=True)
        counts = words.counts
        per_doc = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
        starts = np.repeat(words.first[:-1] - (np.cumsum(per_doc) - per_doc), per_doc) + np.arange(per_doc.sum())
        if not len(starts):
            continue
        lasts = np.minimum(starts + shingle, np.repeat(words.first[1:], per_doc)) - 1
        text, hashed = words.text, xxhash.xxh64_intdigest
        values = np.fromiter(
            (hashed(text[s:e], 42) for s, e in zip(words.start[starts].tolist(), words.end[lasts].tolist())),
            np.uint64, len(starts))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        some = np.flatnonzero(per_doc)
        sums = np.add.reduceat(bits, (np.cumsum(per_doc) - per_doc)[some], axis=0, dtype=np.int32)
        majority = 2 * sums > per_doc[some, None]
        out[low + some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, key, fp)`` per row of ``docs(doc_id, text)``: the 64-bit SimHash of its lower-cased word shingles.

    Null and empty texts have the fingerprint 0; a text of fewer words than a shingle is one shingle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array(_fingerprint(batch.column("text"), shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), fp], ["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


@lru_cache(maxsize=4)
def _ball(radius: int) -> np.ndarray:
    """Every 64-bit mask of at most ``radius`` set bits."""
    return np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(64), r)], np.uint64)


def _bucket(values: np.ndarray, positions: Sequence[int]) -> np.ndarray:
    """The bits at ``positions``, the first of them highest. It is linear: bucket(x ^ mask) = bucket(x) ^ bucket(mask)."""
    out = np.zeros(len(values), np.int64)
    for i in positions:
        out = (out << 1) | ((values >> np.uint64(i)) & np.uint64(1)).astype(np.int64)
    return out


def _slice(values: np.ndarray, bits: int) -> np.ndarray:
    """One of ``1 << bits`` slices of a bucket: sums of columns drawn for all 64 positions, so linear too."""
    out = np.zeros(len(values), np.int64)
    for i, flips in enumerate(np.random.default_rng(bits).integers(1, 1 << bits, 64).tolist() if bits else ()):
        out ^= np.where((values >> np.uint64(i)) & np.uint64(1) > 0, flips, 0)
    return out


def _reached(depth: int, radius: int) -> int:
    """How many buckets of ``depth`` positions the variants of one fingerprint fall into."""
    return sum(math.comb(depth, r) for r in range(min(depth, radius) + 1))


@dataclass
class Buckets:
    """Buckets are leaves of a binary tree over bit positions, numbered 1, then 2n and 2n + 1 below n: all nodes of less
    than ``depth`` positions are inner ones, and those in ``inner``.
    """

    positions: list[int]
    depth: int
    radius: int
    inner: np.ndarray

    def of(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``values`` and the buckets that variants of the value there fall into, each bucket once."""
        source, node = np.arange(len(values)), np.ones(len(values), np.int64)
        left = np.full(len(values), self.radius, np.int8)
        found = [(source[:0], node[:0])]
        for depth in range(DEEPEST + 1):
            if depth >= self.depth:
                further = np.isin(node, self.inner)
                found.append((source[~further], node[~further]))
                source, node, left = source[further], node[further], left[further]
                if not len(source):
                    break
            own = _bucket(values[source], self.positions[depth:depth + 1])
            may = left > 0
            node = np.concatenate([2 * node + own, (2 * node + 1 - own)[may]])
            source, left = np.concatenate([source, source[may]]), np.concatenate([left, left[may] - 1])
        return np.concatenate([s for s, _ in found]), np.concatenate([n for _, n in found])

    def steps(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Slices of a column of fingerprints, with what ``of`` says of each."""
        values = column.to_numpy(zero_copy_only=False).view(np.uint64)
        step = max(1, (1 << 20) // _reached(self.depth, self.radius))
        for low in range(0, len(values), step):
            yield (values[low:low + step], *self.of(values[low:low + step]))

    def send(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fingerprints for one bucket travel as one binary value per slice."""
        for batch in batches:
            for values, source, node in self.steps(batch.column("fp")):
                order = np.argsort(node, kind="stable")
                found, begin = np.unique(node[order], return_index=True)
                sent = np.split(values[source[order]], begin[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array([x.tobytes() for x in sent], pa.binary())], ["bucket", "fps"])

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, node in self.steps(batch.column("fp")):
                found, n = np.unique(node, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["bucket", "n"])


def buckets(distinct: DataFrame, radius: int, most: int = BUCKET_FINGERPRINTS) -> Buckets:
    """Buckets that hold ``most`` fingerprints of ``distinct(fp)`` at most.

    Bit positions are taken in the order of their balance over all fingerprints. As many make buckets as even ones would
    need; then buckets are counted, and those that hold more are split by the next ``SPLIT`` positions until none does. The driver
    gets 65 counts, and the numbers of buckets that are too full: one for ``most`` fingerprints sent, at most.
    """
    ones = [F.sum(F.getbit("fp", F.lit(i)).cast("long")) for i in range(64)]
    n, *ones = distinct.agg(F.count("*"), *ones).first()
    positions = sorted(range(64), key=lambda i: (abs(2 * (ones[i] or 0) - n), i))
    depth = MIN_DEPTH
    while depth < DEEPEST and n * _reached(depth, radius) >> depth > most:
        depth += 1
    out = Buckets(positions, depth, radius, np.zeros(0, np.int64))
    while True:
        counted = distinct.select("fp").mapInArrow(out.count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
        full = [r.bucket for r in counted.where(F.col("n") > most).select("bucket").collect() if r.bucket < 1 << DEEPEST]
        if not full:
            return out
        below = np.array(full, np.int64)
        for _ in range(SPLIT):
            out = replace(out, inner=np.union1d(out.inner, below))
            below = np.concatenate([2 * below, 2 * below + 1])
            below = below[below < 1 << DEEPEST]


def _groups(fps: np.ndarray, node: int, positions: list[int], radius: int, sorted_variants: int):
    """Variants of ``fps`` in one bucket, and the positions of their sources, slice by slice; equal variants share a slice."""
    masks, used = _ball(radius), positions[:node.bit_length() - 1]
    kinds, of_mask, sizes = np.unique(_bucket(masks, used), return_inverse=True, return_counts=True)
    # masks of one kind lead from a fingerprint to this bucket
    need = np.searchsorted(kinds, _bucket(fps, used) ^ (node - (1 << len(used))))
    bits = max(0, math.ceil(math.log2(max(1, sizes[need].sum() / sorted_variants))))
    finer = (of_mask << bits) | _slice(masks, bits)
    by_slice = np.argsort(finer, kind="stable")
    ranges = np.searchsorted(finer[by_slice], np.arange((len(kinds) << bits) + 1))
    key = (need << bits) | _slice(fps, bits)
    order = np.argsort(key, kind="stable")
    found, begin = np.unique(key[order], return_index=True)
    for number in range(1 << bits):
        variants, sources = [], []
        for k, low, high in zip(found.tolist(), begin.tolist(), [*begin[1:].tolist(), len(fps)]):
            k ^= number
            some = masks[by_slice[ranges[k]:ranges[k + 1]]]
            variants.append((fps[order[low:high], None] ^ some[None, :]).ravel())
            sources.append(np.repeat(order[low:high].astype(np.int32), len(some)))
        yield np.concatenate(variants), np.concatenate(sources)


def _forest(pairs: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Lowers ``label`` until both ends of every pair have the same."""
    while len(pairs):
        before = label.copy()
        np.minimum.at(label, pairs[:, 0], before[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 1], before[pairs[:, 0]])
        label = label[label]
        if (label == before).all():
            break
    return label


def _collide(positions: list[int], radius: int, max_bits: int, sorted_variants: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(np.frombuffer(b"".join(rows["fps"]), np.uint64))
        every = [np.zeros((0, 2), np.int32)]
        for variant, source in _groups(fps, int(key[0]), positions, radius, sorted_variants):
            # an odd radius is rounded up, so the first of a group must be the nearest to the variant: all others reach it,
            # unless none is nearer than the radius, and then pairs within max_bits share another variant
            order = np.lexsort((np.bitwise_count(fps[source] ^ variant), variant)) if max_bits % 2 else np.argsort(variant, kind="stable")
            variant, source = variant[order], source[order]
            new = np.concatenate(([True], variant[1:] != variant[:-1]))
            again, head = np.flatnonzero(~new), np.flatnonzero(new)
            # all that share a variant link to the first of them
            hub = source[head[np.searchsorted(head, again, side="right") - 1]]
            pairs = np.unique(np.stack([hub, source[again]], 1), axis=0)
            every.append(pairs[np.bitwise_count(fps[pairs[:, 0]] ^ fps[pairs[:, 1]]) <= max_bits])
        # a tree for each connected part is enough
        label = _forest(np.unique(np.concatenate(every), axis=0), np.arange(len(fps)))
        linked = np.flatnonzero(label != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked].view(np.int64), "b": fps[label[linked]].view(np.int64)})
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_fingerprints: int = BUCKET_FINGERPRINTS,
          sorted_variants: int = SORTED_VARIANTS) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints in ``distinct(fp)`` that differ in at most ``max_bits`` bits.

    Every fingerprint stands in for all its variants within half the radius; two fingerprints within the radius share
    one. Each bucket sorts its variants, verifies the pairs that collide and returns a spanning tree of them, so
    a group of n near copies gives n - 1 edges per bucket at most. Variants that share a bucket travel as their fingerprint:
    the bucket knows which masks lead to it. A bucket is some bit positions, so a fingerprint goes to few of them (to 22
    of 64, 92 of 8,192), and a bucket that is too full is split by more positions; within a bucket, variants are
    made and sorted in slices.
    """
    radius = (max_bits + 1) // 2
    dealt = buckets(distinct, radius, bucket_fingerprints)
    sent = distinct.select("fp").mapInArrow(dealt.send, "bucket long, fps binary")
    return sent.groupBy("bucket").applyInPandas(_collide(dealt.positions, radius, max_bits, sorted_variants), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, key, fp, fingerprint, component_id, representative)`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id of the documents reachable over links of at most ``max_bits`` differing bits,
    itself included; null ids are passed over (null if there is no other). ``representative`` holds for the rows of
    one (doc_id, key) of each component: the smallest, null ids last. Repeated rows keep their number. Empty in, empty
    out.
    """
    rows = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("lead")),
        "distinct")
    roots = components(links(distinct, max_bits))
    linked = written(distinct.join(roots, F.col("fp") == F.col("node")).drop("node"), "linked")
    # read again, so that a component of very many fingerprints may be split in the joins below
    by_root = written(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.min("lead").alias("first")), "roots")
    known = linked.select("fp", "root").join(by_root, "root").select("fp", "component_id", "first")
    named = distinct.join(known, "fp", "left").select(
        "fp", F.when(F.col("first").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("first", "lead").alias("first"))
    # less than FREQUENT rows, whatever the table
    frequent = F.broadcast(distinct.where(F.col("copies") * FREQUENT > rows.count()).select("fp", F.lit(PARTS).alias("parts")))
    dealt = rows.select("*", F.monotonically_increasing_id().alias("nth")).join(frequent, "fp", "left").select(
        "doc_id", "key", "fp", F.coalesce(F.col("nth") % F.col("parts"), F.lit(0)).alias("part"))
    named = named.join(frequent, "fp", "left").select(
        "fp", "component_id", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)).alias("part"))
    return dealt.join(named, ["fp", "part"]).select(
        "doc_id", "key", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("key").eqNullSafe(F.col("first.key")))
        .alias("representative"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that represent their component, one for each, with the columns of ``docs``."""
    own_id, own_key, key = fresh(docs, "own_id"), fresh(docs, "own_key"), fresh(docs, "text_key")
    kept = near_duplicates(docs, shingle, max_bits).where("representative").select(
        F.col("doc_id").alias(own_id), F.col("key").alias(own_key)).distinct()
    keyed = docs.withColumn(key, text_key())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
