import random
import zlib

import numpy as np

from snapdemand.llm import training_order as T

from .conftest import prose
from .test_packing import ids_of


def test_a_bijection_for_every_size_and_key():
    for n in (1, 2, 3, 4, 5, 17, 64, 1000, 4097):
        orders = [T.permuted(np.arange(n), n, key).tolist() for key in (1, 2, 2 ** 70 + 9)]
        assert all(sorted(o) == list(range(n)) for o in orders)
        if n > 60:
            assert orders[0] != orders[1] != list(range(n)) and orders[0] != orders[2]
            assert np.abs(np.corrcoef(np.arange(n), orders[0])[0, 1]) < 0.5


def materialised(docs, length=16, records=8, key=7):
    return T.materialise(docs, key, length=length, shard_bytes=2 * length * records)


def check(order, docs, length):
    records = {r.slot: r for r in order.records().collect()}
    index = {r.slot: r for r in order.index.collect()}
    assert sorted(records) == sorted(index) == list(range(order.n))
    assert all(r.shard == s // order.per_shard and r.offset == s % order.per_shard * order.stride for s, r in records.items())
    left = sorted((d, tuple(ids_of(t))) for d, t in docs)
    got = []
    for s, r in records.items():
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == length and not ids[index[s].n_tokens:].any()
        got += ids[:index[s].n_tokens].tolist()
    assert sorted(got) == sorted(i for _, ids in left for i in ids)


def test_every_token_has_its_place_and_streams_are_whole(spark):
    rng = random.Random(1)
    docs = [(i, prose(rng, rng.choice([0, 1, 5, 30, 100]))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    order = materialised(df)
    check(order, docs, 16)
    # a document's tokens, put together from the sequences that name it, in the order of their numbers
    again = materialised(df)
    assert sorted((r.slot, zlib.crc32(r.ids)) for r in order.records().collect()) == sorted(
        (r.slot, zlib.crc32(r.ids)) for r in again.records().collect())
    other = materialised(df, key=8)
    assert [r.ids for r in order.records().orderBy("slot").collect()] != [r.ids for r in other.records().orderBy("slot").collect()]
    cut = T.sequences(df, length=16).orderBy("part", "number").collect()
    by_doc = {}
    streams = {}
    for r in cut:
        streams.setdefault(r.part, []).extend(np.frombuffer(r.ids, "<u2")[:r.n_tokens].tolist())
        for d in r.doc_ids:
            if not by_doc.get(r.part) or by_doc[r.part][-1] != d:
                by_doc.setdefault(r.part, []).append(d)
    texts = dict(docs)
    for part, stream in streams.items():
        assert stream == [i for d in by_doc[part] for i in ids_of(texts[d])]


def test_shards_are_fixed_stride_files_and_reading_resumes_anywhere(spark):
    docs = [(i, "some words in a row " * 3) for i in range(60)]
    order = materialised(spark.createDataFrame(docs, "doc_id long, text string"))
    files = spark.read.format("binaryFile").load(order.path).select("shard", "length").collect()
    sizes = {f.shard: f.length for f in files}
    assert len(files) == len(sizes) == -(-order.n // 8)
    assert all(sizes[s] == 32 * min(8, order.n - 8 * s) + 1 for s in sizes)
    whole = {r.slot: r.ids for r in order.records().collect()}
    later = order.records(first=13, end=21)
    assert {r.slot: r.ids for r in later.collect()} == {s: whole[s] for s in range(13, 21)}
    assert order.records(first=order.n).count() == 0


def test_digests_and_odd_rows(spark, odd_docs, no_docs):
    docs = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    order = materialised(odd_docs, length=512, records=64)
    check(order, docs, 512)
    rows = T.digests(order).collect()
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in odd_docs.collect()}
    ids = {r.slot: r.ids for r in order.records().collect()}
    assert all(r.ids_crc32 == zlib.crc32(ids[r.slot]) for r in rows) and len(rows) == order.n
    assert T.digests(materialised(no_docs)).count() == 0
