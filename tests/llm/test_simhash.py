import random
import re

import numpy as np
import xxhash

from snapdemand.llm import simhash

from .conftest import prose


def fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=4):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(((doc, f"{fps[i]:016x}", least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=repr), {
        top(i): least.get(top(i)) for i in range(len(rows))}


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for base in range(25):
        words = prose(rng, rng.choice([0, 2, 5, 40, 300])).split()
        for _ in range(rng.randint(1, 6)):
            copy = [w.upper() if rng.random() < 0.1 else w for w in words]
            for _ in range(rng.randint(0, 3)):
                if copy:
                    copy[rng.randrange(len(copy))] = prose(rng, 1)
            rows.append((len(rows) * 7 % 101, rng.choice([" ", "\n", "  "]).join(copy)))
    return rows


def result(df):
    found = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    return sorted((tuple(r) for r in found), key=repr)


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)[0]


def test_links_find_every_pair_within_reach_and_no_other(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for fp in list(fps):
        for bits in (1, 2, 3, 4, 5, 6):
            fps.add(fp ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), bucket_fingerprints=200, sorted_variants=100).collect()
    joined = {f: f for f in fps}

    def top(f):
        while joined[f] != f:
            f = joined[f]
        return f

    for e in edges:
        a, b = e.a % (1 << 64), e.b % (1 << 64)
        joined[top(a)] = top(b)
    true = {f: f for f in fps}

    def top2(f):
        while true[f] != f:
            f = true[f]
        return f

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                true[top2(a)] = top2(b)
    for a in fps:
        for b in fps:
            assert (top(a) == top(b)) == (top2(a) == top2(b))


def connected(nodes, edges):
    """The smallest node that each node is connected to."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def near(seed, n):
    rng = random.Random(seed)
    fps = {rng.getrandbits(64) for _ in range(n)}
    return sorted(fps | {fp ^ sum(1 << b for b in rng.sample(range(64), k)) for fp in fps for k in range(1, 7)})


def found_links(spark, fps, **options):
    signed = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    return connected(fps, [(e.a % (1 << 64), e.b % (1 << 64)) for e in simhash.links(signed, **options).collect()])


def true_links(fps, max_bits):
    return connected(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= max_bits])


def reached(buckets, fp):
    """Leaves of the tree that a variant of one fingerprint falls into, from its definition."""
    found = set()
    for mask in simhash._ball(buckets.radius).tolist():
        node, depth = 1, 0
        while depth < buckets.depth or node in buckets.inner:
            node, depth = 2 * node + ((fp ^ mask) >> buckets.positions[depth] & 1), depth + 1
        found.add(node)
    return found


def test_buckets_are_the_leaves_that_variants_fall_into(spark):
    fps = np.array(near(4, 40), np.uint64)
    for depth, inner in ((6, []), (6, [70, 140, 281, 77]), (9, [600])):
        buckets = simhash.Buckets([i * 7 % 64 for i in range(64)], depth, 2, np.array(inner, np.int64))
        source, node = buckets.of(fps)
        for i, fp in enumerate(fps.tolist()):
            assert sorted(node[source == i].tolist()) == sorted(reached(buckets, fp))
        if not inner:
            assert len(source) == len(fps) * simhash._reached(depth, 2)
    assert simhash._reached(6, 2) == 22 and simhash._reached(13, 2) == 92


def test_a_bucket_hands_out_every_variant_once(spark):
    every, positions = np.array(near(5, 20), np.uint64), [i * 5 % 64 for i in range(64)]
    near_one = (1 << 13) + int(simhash._bucket(every[:1], positions[:13])[0])
    for node in (64 + 17, near_one, 1):
        used = positions[:node.bit_length() - 1]
        fps = every[np.bitwise_count(simhash._bucket(every, used) ^ (node - (1 << len(used)))) <= 2]
        want = sorted(
            (v, i) for i, fp in enumerate(fps.tolist()) for v in (fp ^ m for m in simhash._ball(2).tolist())
            if sum((v >> p & 1) << k for k, p in enumerate(reversed(used))) == node - (1 << len(used)))
        for most in (1 << 21, max(1, len(want) // 40)):
            parts = list(simhash._groups(fps, node, positions, 2, most))
            assert sorted((int(v), int(i)) for vs, s in parts for v, i in zip(vs, s)) == want
            if len(want) > 1000:
                assert max(len(v) for v, _ in parts) < 2 * len(want) / len(parts) + 100


def test_links_are_the_same_over_any_number_of_buckets(spark, monkeypatch):
    fps = near(8, 40)
    for depth in (6, 10, 13):
        monkeypatch.setattr(simhash, "MIN_DEPTH", depth)
        assert found_links(spark, fps, sorted_variants=2000) == true_links(fps, 4)


def test_buckets_that_are_too_full_are_split(spark):
    # twelve bits are the best balanced of all, yet they tell only two halves apart
    rng = random.Random(9)
    same = sum(1 << b for b in range(3, 63, 5))
    fps = sorted({rng.getrandbits(64) & ~same | rng.choice((0, same)) for _ in range(300)} | set(near(10, 5)))
    signed = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    dealt = simhash.buckets(signed, 2, 60)
    assert len(dealt.inner)
    _, node = dealt.of(np.array(fps, np.uint64))
    assert max(np.unique(node, return_counts=True)[1]) <= 60
    assert found_links(spark, fps, bucket_fingerprints=60) == true_links(fps, 4)


def test_one_fingerprint_of_many_rows_is_joined_in_parts(spark):
    rows = [(i, "the same few words in each") for i in range(3000)] + [(5000 + i, prose(random.Random(i), 30)) for i in range(20)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "parts" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.doc_id for r in found.collect()) == sorted(i for i, _ in rows)
    assert found.where("doc_id < 3000 and component_id = 0").count() == 3000 and found.where("representative").count() == 21


def test_odd_numbers_of_bits_equal_brute_force(spark):
    # 0 and 7 are 3 bits apart; around each variant that they share, many others are 4 bits from one of the two
    rng = random.Random(6)
    fps = {0, 7}
    for variant in range(1, 7):
        places = range(3, 32) if variant.bit_count() == 1 else range(32, 64)
        fps |= {variant ^ sum(1 << b for b in rng.sample(places, 2)) for _ in range(100)}
    fps = sorted(fps | set(near(7, 12)))
    for max_bits in (1, 3):
        assert found_links(spark, fps, max_bits=max_bits, sorted_variants=500) == true_links(fps, max_bits)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert result(odd_docs) == brute(rows)[0]
    assert result(no_docs) == []


def test_one_of_each_component_stays(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    kept = simhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(brute(rows)[1].values(), key=repr)
    assert simhash.deduplicated(no_docs).count() == 0


def test_components_of_chains_stars_loops_and_repeats(spark):
    from snapdemand.llm.components import components
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(20, 60)] + [(3, 3), (9, 8), (8, 9), (9, 8)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(20, 60)]} | {8: 8, 9: 8}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
