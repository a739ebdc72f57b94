import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from snapdemand.llm import packing, tokens

from .conftest import prose

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_library():
    rng = random.Random(1)
    bits = [" ", "  ", "\n", "\n\n", "\t", " ", " ", "word", "don't", "'ll", "é", "😀", "123", "##", ".", "<|endoftext|>", "\x1f",
            "a b", "ü", "日本語", "\u0000"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)] + ["", " ", "\n ", "x " * 5000]
    ids, first = tokens.encoder(tokens.VOCABULARY).encode(texts, [])
    for text, a, b in zip(texts, first, first[1:]):
        assert ids[a:b].tolist() == ids_of(text)[:-1], repr(text)
    _, flat, offsets = next(tokens.with_end(pa.array(["a", None, "b c"]), tokens.VOCABULARY))
    assert flat.tolist() == ids_of("a") + [0] + ids_of("b c") and offsets.tolist() == [0, 2, 3, 6]


def fewest(lengths, capacity):
    """Bins needed, by trying all ways."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for b in {bins[j]: j for j in range(len(bins)) if bins[j] + lengths[i] <= capacity}.values():
            bins[b] += lengths[i]
            place(i + 1, bins)
            bins[b] -= lengths[i]
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_optimum_and_often_meet_it():
    rng, met = random.Random(2), 0
    for _ in range(300):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 8))), reverse=True)
        need = fewest(lengths, 20)
        bound = packing.lower_bound(np.bincount(lengths, minlength=21), 20)
        bins, offsets, filled = packing.best_fit(np.array(lengths), 20)
        assert bound <= need <= len(filled)
        met += bound == need
    assert met > 270
    assert packing.lower_bound(np.bincount([11] * 7, minlength=21), 20) == 7
    assert packing.lower_bound(np.bincount([7] * 9, minlength=21), 20) == 5


def check_places(rows, capacity):
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= capacity


def check_pieces(rows, docs, capacity):
    by_row = {}
    for r in rows:
        by_row.setdefault(r.row, []).append(r)
    got = []
    for parts in by_row.values():
        parts.sort(key=lambda r: r.piece)
        got.append((parts[0].doc_id, tuple((p.piece, p.start, p.length, p.ids_crc32) for p in parts)))
    want = []
    for doc, text in docs:
        ids = ids_of(text)
        head = len(ids) if len(ids) <= capacity else (len(ids) - 1) % capacity + 1
        cuts = [0, *range(head, len(ids) + 1, capacity)]
        want.append((doc, tuple((i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                                for i, (a, b) in enumerate(zip(cuts, cuts[1:])))))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pieces_places_and_number_of_sequences(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.choice([0, 3, 10, 20, 30, 200]))) for i in range(400)]
    for part_pieces in (1 << 17, 64):
        rows = packing.packed(spark.createDataFrame(docs, "doc_id long, text string"), capacity=128, part_pieces=part_pieces).collect()
        check_pieces(rows, docs, 128)
        check_places(rows, 128)
        least = packing.lower_bound(np.bincount([r.length for r in rows], minlength=129), 128)
        assert least <= len({r.sequence_id for r in rows}) <= 1.03 * least


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    rows = packing.packed(odd_docs).collect()
    check_pieces(rows, docs, 2048)
    check_places(rows, 2048)
    assert packing.packed(no_docs).count() == 0


def given_pieces(spark, seed, n=1500):
    rng = random.Random(seed)
    rows = [(i, 0, 0, rng.randint(26, 50), 0, i) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long, row long"), rows


def packed_rounds(spark, monkeypatch, seed, **options):
    """Result of a packing, and the number of sequences after each of its rounds."""
    pieces, rows = given_pieces(spark, seed)
    seen, write = [], packing.written

    def spy(df, name, *rest):
        out = write(df, name, *rest)
        if name == "packed":
            seen.append(out)
        return out

    monkeypatch.setattr(packing, "written", spy)
    got = packing.pack(pieces, capacity=100, **options).collect()
    monkeypatch.setattr(packing, "written", write)
    totals, closed = [], 0
    for placed in seen:
        bins = {(r.part, r.bin): r.open for r in placed.select("part", "bin", "open").collect()}
        totals.append(closed + len(bins))
        closed += sum(not o for o in bins.values())
    assert sorted((r.row, r.length) for r in got) == sorted((r[5], r[3]) for r in rows)
    check_places(got, 100)
    return len({r.sequence_id for r in got}), totals


@pytest.mark.parametrize("rounds", [1, 2, 1000])
def test_an_end_of_the_rounds_loses_no_piece(spark, monkeypatch, rounds):
    monkeypatch.setattr(packing, "ROUNDS", rounds)
    n, totals = packed_rounds(spark, monkeypatch, 5, part_pieces=40)
    assert len(totals) <= rounds and n == min(totals)


def test_the_round_of_fewest_sequences_counts(spark, monkeypatch):
    every = [packed_rounds(spark, monkeypatch, seed, part_pieces=100) for seed in range(5)]
    assert all(n == min(totals) for n, totals in every)
    assert any(totals[-1] > min(totals) for _, totals in every)
