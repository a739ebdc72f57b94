"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed-stride records."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import shared_path, written
from .tokens import VOCABULARY, with_end
from .words import mixed

LENGTH = 1024
SHARD_BYTES = 8 << 20
ROUNDS = 6
#: of zstd, for the written sequences and for what is shuffled: disk is scarcer here than time
_LEVEL = 6
_U = np.uint64


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of every index below ``n``: a bijection on 0 .. n - 1 that ``key`` decides.

    A Feistel network permutes the numbers of twice as many bits as half of n's bits need; a result of ``n`` or more
    is permuted again until it is below, which keeps it a bijection.
    """
    half = _U(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (_U(1) << half) - _U(1)
    keys = mixed(np.arange(1, ROUNDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(key % (1 << 64)))
    out, todo = index.astype(_U), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def sequences(docs: DataFrame, path: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """``(part, number, n_tokens, doc_ids, ids)``: the token stream of each task's documents, a 0 behind each, cut every
    ``length`` tokens. ``ids`` are little-endian 16-bit; the last sequence of a task is filled up with 0.

    Null and empty texts are a single 0. ``doc_ids`` are the documents in a sequence, in order.
    """
    def rows(part: int, number: int, ids: np.ndarray, first: np.ndarray, docs: list) -> pa.RecordBatch:
        n = -(-len(ids) // length)
        starts = length * np.arange(n)
        filled = np.concatenate([ids, np.zeros(n * length - len(ids), np.uint32)])
        if len(filled) and filled.max() > 0xFFFF:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        low = np.searchsorted(first, starts, side="right") - 1
        high = np.searchsorted(first, np.minimum(starts + length, len(ids)), side="left")
        raw, size = filled.astype("<u2").tobytes(), 2 * length
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part), pa.int64()), pa.array(number + np.arange(n), pa.int64()),
             pa.array(np.minimum(len(ids) - starts, length), pa.int64()),
             pa.array([docs[a:b] for a, b in zip(low.tolist(), high.tolist())], pa.list_(pa.int64())),
             pa.array([raw[i * size:(i + 1) * size] for i in range(n)], pa.binary())],
            ["part", "number", "n_tokens", "doc_ids", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        rest, rest_first, rest_docs = np.zeros(0, np.uint32), np.zeros(1, np.int64), []
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for low, ids, first in with_end(batch.column("text"), path):
                ids = np.concatenate([rest, ids])
                first = np.concatenate([rest_first[:-1], len(rest) + first])
                docs = [*rest_docs, *doc_ids[low:low + len(first) - 1 - len(rest_docs)]]
                whole = len(ids) // length * length
                if whole:
                    yield rows(part, number, ids[:whole], first, docs)
                number += whole // length
                open_from = int(np.searchsorted(first, whole, side="right")) - 1
                rest, rest_docs = ids[whole:], docs[open_from:]
                rest_first = np.maximum(first[open_from:] - whole, 0)
        if len(rest):
            yield rows(part, number, rest, rest_first, rest_docs)

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "part long, number long, n_tokens long, doc_ids array<long>, ids binary")


@dataclass
class Order:
    """Shards below ``path``: ``shard=k`` holds slots from k * per_shard on, each a record of ``stride`` bytes, one behind the
    other, and one line end behind the last. ``index`` has ``(slot, n_tokens, doc_ids)`` of every sequence.
    """

    spark: SparkSession
    path: str
    n: int
    per_shard: int
    stride: int
    index: DataFrame

    def records(self, first: int = 0, end: int | None = None) -> DataFrame:
        """``(slot, shard, offset, ids)`` of the slots from ``first`` up to ``end``, read from the shards that hold them.

        So a run that stopped at a slot goes on there, and no earlier shard is read.
        """
        end = self.n if end is None else min(end, self.n)
        stride, per_shard = self.stride, self.per_shard
        if first >= end:
            return self.spark.createDataFrame([], "slot long, shard long, offset long, ids binary")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                    data = memoryview(content.as_buffer())
                    at = np.arange(len(data) // stride)
                    at = at[(shard * per_shard + at >= first) & (shard * per_shard + at < end)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard * per_shard + at, pa.int64()), pa.array(np.full(len(at), shard), pa.int64()),
                         pa.array(at * stride, pa.int64()),
                         pa.array([bytes(data[i * stride:(i + 1) * stride]) for i in at.tolist()], pa.binary())],
                        ["slot", "shard", "offset", "ids"])

        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(self.path)
        files = files.where(F.col("shard").between(first // per_shard, (end - 1) // per_shard))
        return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(
            run, "slot long, shard long, offset long, ids binary")


def _deal(base: dict[int, int], n: int, key: int, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=_LEVEL)
        for batch in batches:
            starts = np.array([base[p] for p in batch.column("part").to_pylist()], np.int64)
            slot = permuted(starts + batch.column("number").to_numpy(), n, key)
            order = np.argsort(slot, kind="stable")
            shard, first = np.unique(slot[order] // per_shard, return_index=True)
            ids = batch.column("ids").to_pylist()
            groups = np.split(order, first[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), pa.array([slot[g].astype("<i8").tobytes() for g in groups], pa.binary()),
                 pa.array([packer.compress(b"".join([ids[i] for i in g.tolist()])) for g in groups], pa.binary())],
                ["shard", "slots", "packed"])
    return run


def _assemble(stride: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        unpacker = zstandard.ZstdDecompressor()
        slots = np.frombuffer(b"".join(rows["slots"]), "<i8")
        data = b"".join([unpacker.decompress(p) for p in rows["packed"]])
        records = np.frombuffer(data, np.uint8).reshape(-1, stride)[np.argsort(slots, kind="stable")]
        return pd.DataFrame({"shard": [int(key[0])], "records": [records.tobytes()]})
    return run


def materialise(docs: DataFrame, key: int, path: str | None = None, vocabulary: str = VOCABULARY, length: int = LENGTH,
                shard_bytes: int = SHARD_BYTES) -> Order:
    """Token sequences of ``docs(doc_id, text)`` in the order that ``key`` decides, written below ``path``.

    Sequences are written once as they come, so their numbers hold even if a task runs again; the driver gets one count
    per task. The permutation gives each its global slot, and a range of slots is a shard, written by one task of Spark's
    own writer: an unfinished attempt leaves nothing behind. Shards are even whatever the key, the documents or their
    sources. Without documents there is no shard.
    """
    spark = docs.sparkSession
    cut = written(sequences(docs, vocabulary, length), "sequences", {
        "compression": "zstd", "parquet.compression.codec.zstd.level": str(_LEVEL)})
    counts = {r["part"]: r["count"] for r in cut.groupBy("part").count().collect()}
    base, n = {}, 0
    for part in sorted(counts):
        base[part], n = n, n + counts[part]
    stride = 2 * length
    per_shard = max(1, shard_bytes // stride)
    path = path or shared_path(spark, "shards")
    shards = max(1, math.ceil(n / per_shard))
    dealt = cut.select("part", "number", "ids").mapInArrow(_deal(base, n, key, per_shard), "shard long, slots binary, packed binary")
    whole = dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInPandas(_assemble(stride), "shard long, records binary")
    # the text writer writes a row's bytes as they are, and one line end
    whole.select("shard", F.col("records").cast("string")).write.partitionBy("shard").text(path)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = np.array([base[p] for p in batch.column("part").to_pylist()], np.int64)
            slot = permuted(starts + batch.column("number").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[2:]], ["slot", "n_tokens", "doc_ids"])

    index = cut.select("part", "number", "n_tokens", "doc_ids").mapInArrow(slots, "slot long, n_tokens long, doc_ids array<long>")
    return Order(spark, path, n, per_shard, stride, index)


def digests(order: Order) -> DataFrame:
    """``(slot, shard, offset, n_tokens, doc_ids, ids_crc32)``: what the shards hold, read back, with its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["slot", "shard", "offset", "ids_crc32"])

    read = order.records().mapInArrow(run, "slot long, shard long, offset long, ids_crc32 long")
    return read.join(order.index, "slot").select("slot", "shard", "offset", "n_tokens", "doc_ids", "ids_crc32")
