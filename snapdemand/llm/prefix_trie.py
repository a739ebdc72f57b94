"""Trie of conversations' first turns; totals of subtrees from an Euler tour that is ranked as a linked list."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import running
from .tables import written

#: a conversation takes its first turns, less than SHARED of them, from the first of its GROUP ids
GROUP, SHARED = 100, 6
#: nodes of one block of the tour, whose arcs one task ranks in memory
BLOCK = 1 << 15
#: next arc of the last one
END = -1


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, hash_1, hash_2, chars)`` of every turn of every rebuilt conversation, and ``(conv_id, length)``.

    Conversation c has the first h turns of conversation c - c % 100 (all if it has fewer, none if there is no such), then
    its own after its first h, h being the CRC-32 of c in decimal modulo 6. Turns are ordered by ``turn`` (null first),
    then role and text; null roles and texts are empty. Rows without conv_id belong to no conversation. The two
    hashes stand for (depth, role, text); ``chars`` counts code points of the text.
    """
    given = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    hashed = given.select("*", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "text", "role").alias("h2"),
                          F.length("text").cast("long").alias("chars"))
    numbered = running(hashed, ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"],
                       keep=["conv_id", "h1", "h2", "chars"], name="turns")
    convs = numbered.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    convs = written(convs.select(
        "conv_id", "first", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("h")), "conversations")
    turns = numbered.join(convs.select("conv_id", "first", "h"), "conv_id").select(
        "conv_id", "h", "h1", "h2", "chars", (F.col("at") - F.col("first") + 1).alias("turn_no"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    planned = convs.join(bases, "base", "left").select(
        "conv_id", "base", "n", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    lent = turns.where(F.col("turn_no") < SHARED).select(F.col("conv_id").alias("base"), "turn_no", "h1", "h2", "chars")
    taken = planned.join(lent, "base").where("turn_no <= taken").select(
        "conv_id", F.col("turn_no").alias("depth"), "h1", "h2", "chars")
    own = turns.where("turn_no > h").join(planned.select("conv_id", "taken"), "conv_id").select(
        "conv_id", (F.col("taken") + F.col("turn_no") - F.col("h")).alias("depth"), "h1", "h2", "chars")
    rows = taken.union(own).select(
        "conv_id", "depth", F.xxhash64(F.lit(3), "depth", "h1", "h2").alias("hash_1"),
        F.xxhash64(F.lit(4), "h2", "depth", "h1").alias("hash_2"), "chars")
    lengths = planned.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return rows, lengths


def _prefixes(rows: DataFrame) -> DataFrame:
    """``(conv_id, depth, k1, k2, p1, p2, chars)``: what stands for a turn's prefix, and for the prefix without the turn.

    A prefix is the set of its (depth, role, text), so the exclusive or of their hashes stands for it.
    """
    ordered = running(rows, ["conv_id", "depth"], xors=["hash_1", "hash_2"], name="prefixes")
    before = [F.col(f"hash_{i}_upto").bitwiseXOR(F.col(f"hash_{i}")) for i in (1, 2)]
    starts = ordered.where("depth = 1").select("conv_id", before[0].alias("s1"), before[1].alias("s2"))
    return ordered.join(starts, "conv_id").select(
        "conv_id", "depth", *[F.col(f"hash_{i}_upto").bitwiseXOR(F.col(f"s{i}")).alias(f"k{i}") for i in (1, 2)],
        *[before[i - 1].bitwiseXOR(F.col(f"s{i}")).alias(f"p{i}") for i in (1, 2)], "chars")


def _ends(prefixes: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)``: digest of the ids, ascending and comma-joined, of conversations that end at a node.

    Ids are joined in pieces of 1,024 successive numbers at most; the digest takes piece by piece, so no list is held whole.
    """
    last = lengths.where("length > 0").withColumnRenamed("length", "depth").join(prefixes, ["conv_id", "depth"])
    none = lengths.where("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"),
                                              F.lit(0).cast("long").alias("k2"), "conv_id")
    ends = last.select("depth", "k1", "k2", "conv_id").union(none)
    pieces = ends.groupBy("depth", "k1", "k2", F.shiftright("conv_id", 10).alias("piece")).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def batch_of(nodes: list, digests: list) -> pa.RecordBatch:
            columns = [pa.array([n[i] for n in nodes], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], ["depth", "k1", "k2", "ends_sha256"])

        for batch in batches:
            nodes, digests = [], []
            for *key, ids in zip(*[batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "ids")]):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    nodes.append(node)
                    digests.append(digest.hexdigest())
                node, digest = key, hashlib.sha256(ids.encode())
            yield batch_of(nodes, digests)
        if node is not None:
            yield batch_of([node], [digest.hexdigest()])

    ordered = pieces.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "piece")
    return ordered.select("depth", "k1", "k2", "ids").mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _jump(step: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Last element of every chain ``i, step[i], ...`` (-1 ends it) and the sums of weights from i to there."""
    n = len(step)
    sums = [np.append(w, 0) for w in weights]
    ahead = np.append(np.where(step < 0, n, step), n)
    last = np.where(ahead == n, np.arange(n + 1), ahead)
    while (ahead < n).any():
        sums = [s + s[ahead] for s in sums]
        ahead, last = ahead[ahead], last[last]
    return last[:n], [s[:n] for s in sums]


def _contract(block: int):
    """Ranks the arcs of one block of nodes as far as they follow each other within it.

    Node i has the arcs 2 i (enter) and 2 i + 1 (exit). For both, gives the first arc behind the block's part of the list
    (``END`` behind the tour), and the number of arcs, leaves and savings from the arc to there; and whether the arc
    is the first of its part.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, enter_next, exit_next, leaf, saved = (table.column(c).to_numpy() for c in ("node", "enter_next", "exit_next", "leaf", "saved"))
        order = np.argsort(node)
        n, low = len(node), int(key[0].as_py()) * block * 2
        after = np.stack([enter_next[order], exit_next[order]], 1).ravel()
        step = np.where((after >= low) & (after < low + 2 * n), after - low, -1)
        weights = [np.ones(2 * n, np.int64), np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)]
        weights[1][::2], weights[2][::2] = leaf[order], saved[order]
        last, sums = _jump(step, weights)
        head = np.ones(2 * n, bool)
        head[step[step >= 0]] = False
        columns = {"node": node[order]}
        for side, name in ((0, "enter"), (1, "exit")):
            columns |= {f"{name}_head": head[side::2], f"{name}_to": after[last][side::2]}
            columns |= {f"{name}_{w}": s[side::2] for w, s in zip(("arcs", "leaves", "saved"), sums)}
        return pa.table({k: pa.array(v) for k, v in columns.items()})
    return run


_RANKED = "node long, " + ", ".join(
    f"{s}_head boolean, {s}_to long, {s}_arcs long, {s}_leaves long, {s}_saved long" for s in ("enter", "exit"))
_SUMS = ("arcs", "leaves", "saved")


def _ranked(arcs: DataFrame, block: int) -> DataFrame:
    """``(node, enter_arcs, exit_arcs, n_leaves, saved_tokens)``: arcs from a node's own to the end of the tour, and sums.

    List ranking in two steps: blocks shorten the list to its parts that lie within one, then pointers over parts are
    doubled until all reach the end. Parts are as few as tours cross from block to block.
    """
    parts = written(arcs.groupBy(F.floor(F.col("node") / block).alias("block")).applyInArrow(_contract(block), _RANKED), "parts")

    def heads(side: str, shift: int) -> DataFrame:
        return parts.where(f"{side}_head").select(
            (F.col("node") * 2 + shift).alias("arc"), F.col(f"{side}_to").alias("to"), *[F.col(f"{side}_{s}").alias(s) for s in _SUMS])

    chain = written(heads("enter", 0).union(heads("exit", 1)), "chain")
    while chain.where(F.col("to") != END).limit(1).count():
        ahead = chain.select(F.col("arc").alias("to"), F.col("to").alias("then"), *[F.col(s).alias(f"then_{s}") for s in _SUMS])
        moved = chain.where(F.col("to") != END).join(ahead, "to").select(
            "arc", F.col("then").alias("to"), *[(F.col(s) + F.col(f"then_{s}")).alias(s) for s in _SUMS])
        chain = written(moved.union(chain.where(F.col("to") == END)), "chain")
    # nodes that are entered and left in one part need nothing from the others
    local = [(F.col(f"enter_{s}") - F.col(f"exit_{s}")).alias(s) for s in _SUMS]
    totals = chain.select(F.col("arc").alias("to"), *_SUMS)
    end = chain.sparkSession.range(1).select(F.lit(END).cast("long").alias("to"), *[F.lit(0).cast("long").alias(s) for s in _SUMS])
    totals = totals.union(end)
    one = parts.where("enter_to = exit_to").select("node", *local)
    here = {s: totals.select(F.col("to").alias(f"{s}_to"), *[F.col(c).alias(f"{s}_then_{c}") for c in _SUMS]) for s in ("enter", "exit")}
    two = parts.where("enter_to <> exit_to").join(here["enter"], "enter_to").join(here["exit"], "exit_to").select(
        "node", *[(F.col(f"enter_{s}") + F.col(f"enter_then_{s}") - F.col(f"exit_{s}") - F.col(f"exit_then_{s}")).alias(s) for s in _SUMS])
    return one.union(two)


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (see ``rebuilt``), the textless root at depth 0 included.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``: smallest member; depth;
    parent's smallest member (root: null); members; children; childless nodes of the subtree, itself included; over
    the subtree, each node's (n_convs - 1) times the code points of its last text; digest of the ids that end there.
    Conversations of equal turns are one path; a conversation without turns is a member of the root. Repeated rows
    are turns of their own. An empty table has no root.
    """
    rows, lengths = rebuilt(conversations)
    lengths = written(lengths, "lengths")
    every = lengths.agg(F.min("conv_id"), F.count("*")).first()
    prefixes = written(_prefixes(rows), "prefixes")
    grouped = prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        F.min("chars").alias("chars"))

    def long(value: int | None) -> Column:
        return F.lit(value).cast("long")

    root = lengths.limit(1).select(
        *[long(0).alias(c) for c in ("depth", "k1", "k2")], long(every[0]).alias("conv_id"), long(every[1]).alias("n_convs"),
        long(None).alias("p1"), long(None).alias("p2"), long(0).alias("chars"))
    # numbered by (smallest member, depth), so that a conversation's own nodes follow each other; the root is 0
    nodes = running(written(grouped.union(root), "nodes"), ["conv_id", "depth"], name="numbered").withColumnRenamed("at", "node")
    first = nodes.where("depth = 1").select("*", long(0).alias("parent"), long(every[0]).alias("parent_conv_id"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deeper = nodes.where("depth > 1").join(above, ["depth", "p1", "p2"]).select(*first.columns)
    top = nodes.where("depth = 0").select("*", long(None).alias("parent"), long(None).alias("parent_conv_id"))
    nodes = written(first.union(deeper).union(top), "linked")

    children = nodes.where("depth > 0").groupBy("parent").agg(F.min("node").alias("first_child"), F.count("*").alias("n_children"))
    siblings = running(nodes.where("depth > 0").select("parent", "node"), ["parent", "node"], name="siblings")
    ahead = siblings.select(F.col("parent").alias("next_parent"), F.col("node").alias("next_sibling"), (F.col("at") - 1).alias("at"))
    following = siblings.join(ahead, "at").where("parent = next_parent").select("node", "next_sibling")
    known = written(
        nodes.join(children.withColumnRenamed("parent", "node"), "node", "left").join(following, "node", "left"), "known")
    arcs = known.select(
        "node", F.coalesce(F.col("first_child") * 2, F.col("node") * 2 + 1).alias("enter_next"),
        F.coalesce(F.col("next_sibling") * 2, F.col("parent") * 2 + 1, long(END)).alias("exit_next"),
        F.col("first_child").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    sums = _ranked(arcs, block).select("node", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    none = F.sha2(F.lit(""), 256)
    return known.join(sums, "node").join(_ends(prefixes, lengths), ["depth", "k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", long(0)).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
