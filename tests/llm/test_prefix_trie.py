"""The trie against one built from lists in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from snapdemand.llm import prefix_trie
from snapdemand.llm.order import running

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    saved = {p: (len(m) - 1) * (len(p[-1][1]) if p else 0) for p, m in nodes.items()}
    children = {p: sum(q[:-1] == p for q in nodes if len(q) == len(p) + 1) for p in nodes}
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p],
                    sum(children[q] == 0 for q in below), sum(saved[q] for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    return sorted(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=repr)


def given(seed, convs=60):
    rng = random.Random(seed)
    ids = rng.sample([*range(0, 130), *range(300, 330), *range(501, 520)], convs)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "ño", "", "a longer turn"]))
            for c in ids for t in range(rng.randint(1, 9))]


@pytest.mark.parametrize("seed, block", [(1, 1 << 15), (2, 4), (3, 1), (4, 7)])
def test_equals_plain_lists(spark, seed, block):
    rows = given(seed)
    assert run(spark, rows, block=block) == brute(rows)


def test_one_long_conversation_and_a_common_first_turn(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(400)]
    rows += [(c, 0, "user", "t0") for c in range(1, 100)] + [(c, 1, "user", f"own {c}") for c in range(1, 100)]
    assert run(spark, rows, block=50) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (0, None, None, None), (0, 1, "user", None), (0, 1, "user", "b"), (0, 1, "user", "b"),
            (3, 0, "user", ""), (203, 0, "", "x"), (7, 5, "user", "é" * 5000), (-5, 0, "user", "negative")]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", k1 string, at int")
    got = prefix_trie.trie(frame, block=2)
    want = [r for r in rows if r[0] != -5]
    assert sorted(map(tuple, got.where("conv_id <> -5").collect()), key=repr) != []
    assert run(spark, want) == brute(want)
    assert run(spark, []) == []
    only = [(17, 0, "user", "a")]  # 17 loses its turn to a conversation that is not there, or keeps it
    assert run(spark, only) == brute(only)


def test_positions_and_running_sums_over_partitions(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 5), i, rng.getrandbits(62)) for i in range(500)]
    got = running(spark.createDataFrame(rows, "k int, i long, x long"), ["k", "i"], sums=["i"], xors=["x"], partitions=7).collect()
    total, mixed = 0, 0
    for n, (row, r) in enumerate(zip(sorted(rows), sorted(got, key=lambda r: r["at"]))):
        total, mixed = total + row[1], mixed ^ row[2]
        assert (r["k"], r["i"], r["x"]) == row and (r["at"], r["i_upto"], r["x_upto"]) == (n, total, mixed)


def test_chains_are_ranked():
    last, (n,) = prefix_trie._jump(np.array([2, -1, 3, -1, 0]), [np.ones(5, np.int64)])
    assert last.tolist() == [3, 1, 3, 3, 3] and n.tolist() == [3, 1, 2, 1, 4]
