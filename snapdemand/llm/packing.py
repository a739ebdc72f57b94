"""Best-fit packing of token pieces into sequences, with lower bounds that certify the number of sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .tokens import VOCABULARY, with_end

CAPACITY = 2048
#: pieces that one task packs at once
PART_PIECES = 1 << 17
#: rounds of exchange; as each is a whole result, an end here loses no piece
ROUNDS = 1000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PLACED = f"{PIECES}, part long, bin long, offset long, filled long, open boolean"


def tokenized(docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, row`` and, if asked for, ``ids`` (little-endian uint32).

    A document is its ids and one 0. Longer ones than ``capacity`` are cut so that only the first piece may be shorter.
    Null and empty texts are a single 0. ``row`` tells repeated documents apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, rows = batch.column("doc_id"), batch.column("row")
            for low, ids, first in with_end(batch.column("text"), path):
                total = np.diff(first)
                head = np.where(total > capacity, (total - 1) % capacity + 1, total)
                n = 1 + (total - head) // capacity
                doc = np.repeat(np.arange(len(total)), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[doc])
                at, raw = 4 * (first[doc] + start), memoryview(ids.tobytes())
                cut = [raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                columns = [doc_ids.take(pa.array(low + doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                           pa.array([zlib.crc32(c) for c in cut], pa.int64()), rows.take(pa.array(low + doc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "row"]
                if keep_ids:
                    columns.append(pa.array([bytes(c) for c in cut], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    return given.mapInArrow(run, PIECES + (", ids binary" if keep_ids else ""))


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that pieces of these lengths need at least; ``counts[n]`` pieces have length n.

    The largest of three families of dual feasible functions. Each turns lengths into weights so that what fits into one
    bin weighs at most one, so the total weight is a bound. All arithmetic is on integers.
    """
    length = np.arange(capacity + 1)
    counts = counts.astype(np.int64)
    best = -(-int((length * counts).sum()) // capacity)
    # lengths over capacity - t count as a whole bin, those under t as nothing
    weight, number = np.cumsum(length * counts), np.cumsum(counts)
    for t in range(1, capacity // 2 + 1):
        middle = int(weight[capacity - t] - weight[t - 1])
        best = max(best, int(number[capacity] - number[capacity - t]) - (-middle // capacity))
    # (k + 1) pieces of more than capacity / (k + 1) never fit together
    for k in range(1, 64):
        exact = (k + 1) * length % capacity == 0
        scaled = np.where(exact, k * length, (k + 1) * length // capacity * capacity)  # of k * capacity
        best = max(best, -(-int((scaled * counts).sum()) // (k * capacity)))
    # beside a piece of over half a bin there is room for so many pieces of length t
    for t in range(1, capacity // 2 + 1):
        units = capacity // t
        scaled = np.where(2 * length > capacity, units - (capacity - length) // t, np.where(length >= t, 1, 0))
        best = max(best, -(-int((scaled * counts).sum()) // units))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit over decreasing lengths: bin and offset of every piece, and how far each bin is filled.

    Bins are kept by the room left in them, so each piece goes to the fullest bin that takes it.
    """
    order = np.argsort(-lengths, kind="stable")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    have = 0  # bit n is set if some bin has room for exactly n
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    filled: list[int] = []
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        left = have >> n
        if left:
            r = n + (left & -left).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                have ^= 1 << r
        else:
            b, r = len(filled), capacity
            filled.append(0)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += n
        if r > n:
            room[r - n].append(b)
            have |= 1 << (r - n)
    return bins, offsets, np.array(filled, np.int64)


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins, offsets, filled = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        # a part that its bound certifies gives away its emptiest bin only, another one all that are not full
        if len(filled) > bound:
            again = filled < capacity
        else:
            again = (np.arange(len(filled)) == np.argmin(filled)) & (filled < capacity)
        return rows.assign(bin=bins, offset=offsets, filled=filled[bins], open=again[bins])
    return run


def _bound_of(df: DataFrame, capacity: int) -> int:
    counts = np.zeros(capacity + 1, np.int64)
    for r in df.groupBy("length").count().collect():  # one row per length at most
        counts[r["length"]] = r["count"]
    return lower_bound(counts, capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``pieces`` (as ``tokenized`` gives them, without ids) with ``sequence_id`` and ``offset``.

    Pieces are dealt to parts by hash, and each part is packed best fit, longest first. A part whose number of bins equals
    its lower bound is certified. Parts with a gap then give away the pieces of all bins that are not full, certified
    ones their emptiest bin; these are dealt anew into as few parts as hold them and packed again. That ends when the
    total equals the bound of all lengths together, when one part holds all that is open, or when a round saves nothing,
    which then does not count.
    Full pieces are bins of their own. Offsets have no gap. Empty in, empty out.
    """
    pieces = written(pieces, "pieces")
    n = pieces.count()
    least = _bound_of(pieces, capacity)
    todo, rounds, closed, best, fewest = pieces, [], 0, 0, None
    for turn in range(ROUNDS):
        parts = max(1, math.ceil(n / part_pieces))
        dealt = todo.withColumn("part", F.pmod(F.xxhash64("row", "piece", F.lit(turn)), F.lit(parts)))
        placed = written(dealt.groupBy("part").applyInPandas(_pack(capacity), PLACED), "packed")
        sums = placed.agg(
            F.count_distinct(F.when(~F.col("open"), F.struct("part", "bin"))).alias("kept"),
            F.count_distinct(F.when(F.col("open"), F.struct("part", "bin"))).alias("open"),
            F.count(F.when(F.col("open"), 1)).alias("n")).first()
        rounds.append(placed)
        total = closed + sums["kept"] + sums["open"]
        if fewest is not None and total >= fewest:
            break
        best, fewest = turn, total
        if parts == 1 or total <= least or not sums["n"]:
            break
        closed, n = closed + sums["kept"], sums["n"]
        todo = placed.where("open").drop("part", "bin", "offset", "filled", "open")
    # every round, with what was closed before it, holds all pieces: the one of fewest sequences is the result
    out = None
    for turn, placed in enumerate(rounds[:best + 1]):
        named = (placed if turn == best else placed.where(~F.col("open"))).select(
            "doc_id", "piece", "start", "length", "ids_crc32", "row",
            (F.lit(turn).cast("long") * F.lit(1 << 53) + F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"),
            "offset")
        out = named if out is None else out.union(named)
    return out


def packed(docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``docs(doc_id, text)`` tokenised, cut and packed; see ``tokenized`` and ``pack``."""
    return pack(tokenized(docs, path, capacity), capacity, part_pieces)
