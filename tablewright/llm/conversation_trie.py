"""Prefix trie of conversations from vertical bitmaps.

A node is a distinct sequence of first turns; its members are the conversations that
start with it. Conversations are cut into shards of whole runs of turns. In a shard every
(position, turn) has a posting, the bitset of the conversations with that turn there. The
walk goes depth first: the lowest conversation still left in a node names a turn, the
node's bitset intersected with that turn's posting is a child, and so on until none is
left. Popcounts are members, lowest bits the smallest members, and the members without a
further turn are the node's end list of that shard.

Nodes of different shards are the same where their keys are: two 64-bit words, the
exclusive or of one hash per turn and place. Counts then add up over the shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.windows import running_total
from tablewright.runtime import cut_and_measure, cut_lineage

# Turns of one conversation in a run, and about the turns in a shard.
RUN = 1024
SHARD = 32_768
KEY = ["x1", "x2"]


class Trie(NamedTuple):
    """``nodes``: one row per node. ``ends``: the end lists, one row per node and shard."""

    nodes: DataFrame
    ends: DataFrame


def numbered_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns as (conv, place, k1, k2, chars), places from 1 by turn, null first.

    Equal turn numbers are ordered by role, then text; rows equal in all of these are
    turns of their own. A null role or text counts as empty, rows without a conversation
    are left out, and other columns are not read. ``k1`` and ``k2`` stand for role and text.
    A conversation that holds a large share of all turns is numbered in blocks.
    """
    turns = conversations.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running_total(turns, "conv", ["turn", "role", "text"], "one", "place", frame="rows")
    return placed.select(
        "conv",
        "place",
        F.xxhash64("role", "text").alias("k1"),
        F.xxhash64(F.lit(1), "text", "role").alias("k2"),
        F.length("text").cast("long").alias("chars"),
    )


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their family's head.

    Conversation c starts with the first h turns of conversation c - c mod ``family`` (all
    if it has fewer, none if it is absent), with h the checksum of its decimal id mod
    ``most``, and goes on with its own turns after its first h. Returns the turns, and one row
    per conversation with its ``length``, which may be 0.
    """
    turns = cut_lineage(turns)
    head = F.try_subtract(F.col("conv"), F.pmod("conv", F.lit(family)))
    own_skipped = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    heads = turns.filter(F.pmod("conv", F.lit(family)) == 0)
    owned = turns.groupBy("conv").agg(F.max("place").alias("owned"))
    sizes = heads.groupBy(F.col("conv").alias("head")).agg(F.max("place").alias("has"))
    taken = F.least("skipped", F.coalesce("has", F.lit(0))).alias("taken")
    convs = cut_lineage(
        owned.withColumns({"skipped": own_skipped, "head": head})
        .join(sizes, "head", "left")
        .select("conv", "head", taken, (taken + F.greatest(F.col("owned") - F.col("skipped"), F.lit(0))).alias("length"))
    )
    first = heads.filter(F.col("place") < most).withColumnRenamed("conv", "head")
    copied = (
        convs.filter("taken > 0").select("conv", "head", "taken").join(first, "head").filter("place <= taken")
        .select("conv", "place", "k1", "k2", "chars")
    )
    kept = (
        turns.withColumns({"skipped": own_skipped, "head": head})
        .filter(F.col("place") > F.col("skipped"))
        .join(sizes, "head", "left")
        .select("conv", (taken + F.col("place") - F.col("skipped")).alias("place"), "k1", "k2", "chars")
    )
    return copied.unionByName(kept), convs.select("conv", "length")


def _runs(turns: DataFrame, convs: DataFrame, run: int) -> tuple[DataFrame, int]:
    """Turns in runs of ``run`` places, written down, and their number.

    ``g1`` and ``g2`` hash a turn at its place; a run after the first knows the key and the
    characters of all before it. A conversation without turns is a row at place 0.
    """
    at = turns.withColumns(
        {
            "run": F.floor((F.col("place") - 1) / run),
            "g1": F.xxhash64("k1", "place"),
            "g2": F.xxhash64("k2", "place", F.lit(1)),
        }
    )
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"s1": F.bit_xor("g1"), "s2": F.bit_xor("g2"), "s_chars": F.sum("chars")}
    totals = at.groupBy("conv", "run").agg(*(column.alias(name) for name, column in sums.items()))
    starts = totals.select(
        "conv", "run", F.bit_xor("s1").over(earlier).alias("s1"), F.bit_xor("s2").over(earlier).alias("s2"),
        F.sum("s_chars").over(earlier).alias("s_chars"),
    ).filter("run > 0")
    begun = at.join(cut_lineage(starts), ["conv", "run"], "left").na.fill(0, ["s1", "s2", "s_chars"])
    zero = F.lit(0).cast("long")
    silent = convs.filter("length = 0").select(
        "conv", F.lit(-1).cast("long").alias("run"), zero.alias("place"),
        *(zero.alias(name) for name in ("k1", "k2", "chars", "g1", "g2", "s1", "s2", "s_chars")),
    )
    marked = begun.unionByName(silent).join(convs, "conv").withColumn("last", F.col("place") == F.col("length"))
    rows, state = cut_and_measure(marked.drop("length"))
    return rows, state["rows"]


def _in_shards(rows: DataFrame, parts: int) -> DataFrame:
    """Whole runs together, in order: what the shards of a task are cut from."""
    return rows.repartitionByRange(parts, "run", "conv").sortWithinPartitions("run", "conv", "place")


class _Node(NamedTuple):
    parent: int
    depth: int
    key: tuple[int, int]
    above: tuple[int, int]
    members: int
    stopped: int
    row: int
    before: int


def _walk(rows: dict[str, np.ndarray], conv: np.ndarray, first: np.ndarray) -> list[_Node]:
    """Nodes of one shard, parents before children. Bit c stands for the shard's c-th run."""
    place, k1, k2, g1, g2, chars = (rows[name].tolist() for name in ("place", "k1", "k2", "g1", "g2", "chars"))
    starts, ends = first.tolist(), [*first[1:].tolist(), len(place)]
    postings: dict[tuple[int, int, int], int] = {}
    present: dict[int, int] = {}
    roots: dict[tuple[int, int], int] = {}
    for number, (begin, end) in enumerate(zip(starts, ends)):
        bit = 1 << number
        start = (int(rows["s1"][begin]), int(rows["s2"][begin]))
        roots[start] = roots.get(start, 0) | bit
        for row in range(begin, end):
            turn = (place[row], k1[row], k2[row])
            postings[turn] = postings.get(turn, 0) | bit
    for (at, _, _), members in postings.items():
        present[at] = present.get(at, 0) | members
    nodes: list[_Node] = []
    base = place[0] - 1
    todo = []
    for key, members in roots.items():
        lowest = (members & -members).bit_length() - 1
        todo.append((-1, base, key, members, int(rows["s_chars"][starts[lowest]])))
    while todo:
        parent, depth, key, left, before = todo.pop()
        depth += 1
        left &= present.get(depth, 0)
        while left:
            lowest = (left & -left).bit_length() - 1
            row = starts[lowest] + depth - 1 - base
            members = left & postings[depth, k1[row], k2[row]]
            left ^= members
            mine = (key[0] ^ g1[row], key[1] ^ g2[row])
            nodes.append(_Node(parent, depth, mine, key, members, members & ~present.get(depth + 1, 0), row, before))
            todo.append((len(nodes) - 1, depth, mine, members, before + chars[row]))
    return nodes


def _bits(members: int) -> Iterator[int]:
    while members:
        lowest = members & -members
        yield lowest.bit_length() - 1
        members ^= lowest


def _shards(batches: Iterator[pa.RecordBatch], shard: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Whole runs of at least ``shard`` rows together, of one place in their conversations."""

    def parted(rows: dict[str, np.ndarray]):
        """The ids of the runs, and where each begins."""
        first = np.flatnonzero(np.concatenate(([True], np.diff(rows["conv"]) != 0)))
        return rows, rows["conv"][first], first

    held: dict[str, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
        held = {name: np.concatenate((held[name], new[name])) for name in new} if held else new
        while True:
            runs = held["run"]
            change = int(np.searchsorted(runs, runs[0], side="right"))
            if change == len(runs):
                if change < shard + RUN:
                    break
                # The last conversation may go on in the next batch.
                change = int(np.searchsorted(held["conv"], held["conv"][-1]))
                if not change:
                    break
            end = change
            if end > shard:
                end = int(np.searchsorted(held["conv"][:change], held["conv"][shard], side="left"))
                end = end or int(np.searchsorted(held["conv"][:change], held["conv"][0], side="right"))
            yield parted({name: values[:end] for name, values in held.items()})
            held = {name: values[end:] for name, values in held.items()}
            if not len(held["run"]):
                held = {}
                break
    while held:
        end = int(np.searchsorted(held["run"], held["run"][0], side="right"))
        yield parted({name: values[:end] for name, values in held.items()})
        held = {name: values[end:] for name, values in held.items()} if end < len(held["run"]) else {}


def _found(rows: DataFrame, shard: int) -> DataFrame:
    """Nodes of every shard: key, parent's key, depth, smallest member, members, ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, conv, first in _shards(batches, shard):
            if held["run"][0] < 0:
                found = [(0, 0, 0, 0, 0, int(conv[0]), len(conv), 0, conv.tolist())]
            else:
                last, stops = held["last"].tolist(), [*(first[1:] - 1).tolist(), len(held["run"]) - 1]
                ids = conv.tolist()
                found = [
                    (
                        *node.key, node.depth, *node.above, ids[(node.members & -node.members).bit_length() - 1],
                        node.members.bit_count(), node.before, [ids[c] for c in _bits(node.stopped) if last[stops[c]]],
                    )
                    for node in _walk(held, conv, first)
                ]
            columns = list(zip(*found))
            kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["x1", "x2", "depth", "p1", "p2", "conv_id", "n_convs", "before", "ends"]
    return rows.mapInArrow(run, ", ".join(f"{name} long" for name in names[:-1]) + ", ends array<long>")


def _summed(rows: DataFrame, shard: int) -> DataFrame:
    """Per node and shard, sums over its members of their ``weight`` and ``leaf``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, conv, first in _shards(batches, shard):
            if held["run"][0] < 0:
                continue
            nodes = _walk(held, conv, first)
            weight, leaf = held["weight"][first].tolist(), held["leaf"][first].tolist()
            weights, leaves = [0] * len(nodes), [0] * len(nodes)
            for number in range(len(nodes) - 1, -1, -1):
                node = nodes[number]
                for c in _bits(node.stopped):
                    weights[number] += weight[c]
                    leaves[number] += leaf[c]
                if node.parent >= 0:
                    weights[node.parent] += weights[number]
                    leaves[node.parent] += leaves[number]
            keys = list(zip(*(node.key for node in nodes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (*keys, weights, leaves)], names=["x1", "x2", "weight", "leaves"]
            )

    return rows.mapInArrow(run, "x1 long, x2 long, weight long, leaves long")


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of every node's end list, read chunk by chunk in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None

        def row() -> pa.RecordBatch:
            columns = [pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, names=[*KEY, "ends_sha256"])

        for batch in batches:
            for x1, x2, ids in zip(*(batch.column(name).to_pylist() for name in (*KEY, "ends"))):
                if key != (x1, x2):
                    if key is not None:
                        yield row()
                    key, digest = (x1, x2), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ids)).encode())
        if key is not None:
            yield row()

    chunks = ends.select(*KEY, F.get("ends", F.lit(0)).alias("first"), "ends")
    ordered = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return ordered.mapInArrow(run, "x1 long, x2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, run: int = RUN, shard: int = SHARD) -> Trie:
    """Trie of conversations: turns (conv, place, k1, k2, chars), lengths (conv, length).

    Nodes have a key (``x1``, ``x2``; the root 0, 0), ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id`` (null at the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves`` (childless nodes at or below), ``saved_tokens`` (at or below, members
    but one times the characters of the last turn) and ``ends_sha256`` (of the ids that end
    there, ascending, comma-joined). Repeated conversations are members of the same nodes.
    No conversations, no nodes.

    Sums over a node's subtree are sums over its members: every node is counted with its
    smallest member c, and with W(c) the characters of c before the first node whose smallest
    member is c (all of them if there is none), the saving below a node with B characters
    before its last turn is the sum of W - B over all its members but the smallest.

    A shard holds whole runs of up to ``run`` turns, so a conversation of any length and a
    prefix shared by any number of conversations spread over shards; one row per node and
    shard is shuffled. Only ids are kept in end lists, in lists of one shard's length.
    """
    rows, number = _runs(turns, convs, run)
    parts = max(1, -(-2 * number // shard))
    found = cut_lineage(_found(_in_shards(rows, parts), shard))
    ends = found.filter(F.size("ends") > 0).select(*KEY, "ends")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    merged = (
        found.filter("depth > 0").groupBy(*KEY)
        .agg(
            F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.min("before").alias("before"),
        )
        .unionByName(
            root.select(zero.alias("x1"), zero.alias("x2"), zero.alias("depth"), F.lit(None).cast("long").alias("p1"),
                        F.lit(None).cast("long").alias("p2"), "conv_id", "n_convs", zero.alias("before"))
        )
    )
    children = merged.filter("depth > 0").groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = cut_lineage(merged.join(children, KEY, "left").na.fill(0, ["n_children"]))

    owners = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("before").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    totals = turns.groupBy("conv").agg(F.sum("chars").alias("total"))
    scalars = cut_lineage(
        convs.join(totals, "conv", "left").join(owners, "conv", "left").select(
            "conv", F.coalesce("owned", "total", zero).alias("weight"), F.coalesce("leaf", zero).alias("leaf")
        )
    )
    sums = _summed(_in_shards(rows.join(scalars, "conv"), parts), shard)
    below = sums.groupBy(*KEY).agg(F.sum("weight").alias("weight"), F.sum("leaves").alias("n_leaves"))
    whole = scalars.agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("n_leaves"))
    below = below.unionByName(whole.select(zero.alias("x1"), zero.alias("x2"), "weight", "n_leaves"))

    parents = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    own = scalars.select(F.col("conv").alias("conv_id"), F.col("weight").alias("own"))
    result = (
        nodes.join(below, KEY)
        .join(own, "conv_id")
        .join(_end_digests(ends), KEY, "left")
        .join(parents, ["p1", "p2"], "left")
        .select(
            *KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("weight") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
    return Trie(result, ends)
