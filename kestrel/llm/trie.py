"""Prefix trie of conversations: ternary search trees per range shard.

``encode`` gives every distinct turn (role, text) a number from a dictionary keyed by the turn's
SHA-256 and turns each conversation into an array of turn numbers. ``build`` returns one row per
node of the trie, that is per distinct beginning of a conversation, the empty one included.

Equal sequences are grouped first, so copies of a conversation are one sequence with a count; their
ids are gathered in blocks of at most ``BLOCK_IDS`` ids and hashed as a stream, in ascending order.
The distinct sequences are range-partitioned and cut into shards of about ``SHARD_TURNS`` turns.
Each shard inserts its sequences median first into a ternary search tree; nodes are numbered as
they are made, so one backward loop over the numbers adds members, children, leaves and lengths to
the parents. A beginning occurs in several shards only if it is shared by the last sequence of one
shard and the first of the next; each shard learns those two lengths from its neighbours' edges.
Such boundary nodes are counted as made by their first shard and merged by sums, keyed by a chained
SHA-256; all other nodes are final where they are made.

Texts are read once and never shuffled. One conversation's turn numbers, one shard, and the
neighbouring edges are what a task holds.

Defined results: turns go by number, null first, then by role and SHA-256; null roles and texts are
empty; repeated rows are turns of their own; rows with null conversations form one conversation,
which counts as a member but has no number to show; an empty table has no nodes, not even a root;
other columns are not read. Conversation ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ref, staged

SHARD_TURNS = 1 << 16
BLOCK_IDS = 1 << 16

TURNS = "array<struct<id:long,chars:int>>"
_SEQUENCES = "part int, piece int, ids array<long>, chars array<int>, n long, low long, ends string"
_NODES = """part int, piece int, depth long, turn_id long, conv long, n_convs long, n_children long, n_leaves long, spent long, own long, ends_sha256 string,
shared boolean, key binary, parent_key binary, parent_conv long"""
NO_ENDS = hashlib.sha256(b"").hexdigest()


def encode(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, turns) with ``turns`` an array of (id, chars), and the dictionary (sha, id)."""
    who, what = F.coalesce(ref(role), F.lit("")), F.coalesce(ref(text), F.lit(""))
    sha = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256))
    turns = staged(rows.select(ref(conv).cast("long").alias("conv"), ref(turn).alias("turn"), who.alias("role"), sha.alias("sha"), F.length(what).alias("chars")), "trie-turns")
    dictionary = staged(turns.select("sha").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "sha", "id", "chars")))
    convs = turns.join(dictionary, "sha").groupBy("conv").agg(said.alias("said"))
    return staged(convs.select("conv", F.transform("said", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns")), "trie-convs"), dictionary


def build(convs: DataFrame, shard_turns: int = SHARD_TURNS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per node: depth, turn_id (of its last turn), conv (smallest member), parent_conv,
    n_convs, n_children, n_leaves, saved (characters), ends_sha256.

    ``convs`` has one row per conversation: conv and turns, as from :func:`encode`.
    """
    blocks = convs.groupBy("turns", F.expr(f"conv div {block_ids}").alias("block")).agg(F.sort_array(F.collect_list("conv")).alias("convs"), F.count("*").alias("n"))
    line = blocks.repartitionByRange("turns").sortWithinPartitions("turns", "block")
    line = line.select(F.col("turns")["id"].alias("ids"), F.col("turns")["chars"].alias("chars"), "convs", "n")
    shards = staged(line.mapInArrow(_sequences(shard_turns), _SEQUENCES), "trie-shards")
    nodes = staged(shards.join(_edges(shards), ["part", "piece"]).groupBy("part", "piece").applyInArrow(_nodes, _NODES), "trie-nodes")

    merged = nodes.where("shared").groupBy("key").agg(
        *[F.max(c).alias(c) for c in ("depth", "turn_id", "ends_sha256", "parent_key")],
        F.min("conv").alias("conv"),
        F.min(F.struct("part", "piece")).alias("at"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "own")],
    )
    # a shard's rows meet the merged nodes of their own shard, so that the root's children are no hot key
    parents = nodes.where("shared").select("part", "piece", "key").join(merged.select("key", F.col("conv").alias("merged_conv")), "key")
    every = nodes.where("NOT shared").unionByName(merged.select("*", "at.*").drop("at"), allowMissingColumns=True)
    return every.drop("key").join(parents.withColumnRenamed("key", "parent_key"), ["part", "piece", "parent_key"], "left").select(
        "depth",
        "turn_id",
        "conv",
        F.coalesce("parent_conv", "merged_conv").alias("parent_conv"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("spent") - F.col("own")).alias("saved"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _shared(a: Column, b: Column) -> Column:
    """How many leading items two different arrays share; -1 if one is missing."""
    return F.coalesce(F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False) - 1, F.lit(-1))


def _edges(shards: DataFrame) -> DataFrame:
    """part, piece, left, right: depths shared with the shard before and after."""
    edge = shards.groupBy("part", "piece").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    inside, line = Window.partitionBy("part").orderBy("piece"), Window.orderBy("part")
    edge = edge.select("part", "piece", "first", "last", F.lag("last").over(inside).alias("before"), F.lead("first").over(inside).alias("after"))
    ends = edge.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last"))  # one row for each range partition
    ends = ends.select("part", F.lag("last").over(line).alias("part_before"), F.lead("first").over(line).alias("part_after"))
    left, right = _shared(F.coalesce("before", "part_before"), F.col("first")), _shared(F.col("last"), F.coalesce("after", "part_after"))
    return edge.join(ends, "part").select("part", "piece", left.alias("left"), right.alias("right"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of a list column."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def _sequences(shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        piece = turns = 0
        now = None  # the open sequence: ids, chars, members, smallest id, running digest

        def close() -> tuple:
            nonlocal piece, turns
            ids, chars, n, low, digest = now
            if turns and turns + len(ids) > shard_turns:
                piece, turns = piece + 1, 0
            turns += len(ids) + 1
            return part, piece, np.frombuffer(ids, np.int64), chars, n, low, digest and digest.hexdigest()

        for batch in batches:
            (at, ids), (_, chars), (c_at, convs) = (_lists(batch.column(c)) for c in ("ids", "chars", "convs"))
            out = []
            for i, n in enumerate(batch.column("n").to_pylist()):
                key = ids[at[i] : at[i + 1]].tobytes()
                if now is None or key != now[0]:
                    if now is not None:
                        out.append(close())
                    now = [key, chars[at[i] : at[i + 1]].copy(), 0, None, None]
                now[2] += n
                members = convs[c_at[i] : c_at[i + 1]].tolist()
                if members:
                    text = ",".join(map(str, members)).encode()
                    if now[4] is None:
                        now[3], now[4] = members[0], hashlib.sha256(text)
                    else:
                        now[4].update(b"," + text)
            yield _batch(out)
        if now is not None:
            yield _batch([close()])

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
    names = ["part", "piece", "ids", "chars", "n", "low", "ends"]
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


class TernaryTree:
    """Sequences of numbers. Node 0 is the empty sequence; a node's parent has a smaller number."""

    def __init__(self) -> None:
        self.turn, self.low, self.high, self.down, self.parent, self.depth, self.chars = [-1], [-1], [-1], [-1], [-1], [0], [0]

    def _add(self, turn: int, chars: int, parent: int) -> int:
        for column, value in ((self.turn, turn), (self.low, -1), (self.high, -1), (self.down, -1), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.chars, chars)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list[int], chars: list[int]) -> int:
        """The node of ``ids``, made if need be."""
        node = 0
        for turn, size in zip(ids, chars, strict=True):
            side, at = self.down, node
            while (found := side[at]) >= 0 and self.turn[found] != turn:
                side, at = (self.low if turn < self.turn[found] else self.high), found
            if found < 0:
                found = side[at] = self._add(turn, size, node)
            node = found
        return node

    def path(self, node: int, depth: int) -> list[int]:
        """The nodes above ``node`` (itself included) of at most this depth, from the top."""
        out = []
        while node >= 0:
            if self.depth[node] <= depth:
                out.append(node)
            node = self.parent[node]
        return out[::-1]


def _nodes(shard: pa.Table) -> pa.Table:
    shard = shard.combine_chunks()
    left, right = shard["left"][0].as_py(), shard["right"][0].as_py()
    seqs = sorted(zip(shard["ids"].to_pylist(), shard["chars"].to_pylist(), shard["n"].to_pylist(), shard["low"].to_pylist(), shard["ends"].to_pylist(), strict=True), key=lambda s: s[0])
    tree, place = TernaryTree(), [0] * len(seqs)
    for i in _median_first(len(seqs)):
        place[i] = tree.insert(seqs[i][0], seqs[i][1])

    size = len(tree.turn)
    members, kids, leaves, spent, own = [0] * size, [0] * size, [0] * size, [0] * size, [0] * size
    smallest, ends = [None] * size, [None] * size
    for node, (_, _, n, low, digest) in zip(place, seqs, strict=True):
        members[node], smallest[node], ends[node] = n, low, digest
    before, after = tree.path(place[0], left), tree.path(place[-1], right)
    earlier = set(before)  # made by a shard before this one
    goes_on = place[-1] if right == tree.depth[place[-1]] else -1  # its children are in the next shard
    inner = set(tree.parent)
    for node in range(size - 1, -1, -1):
        made = node not in earlier
        spent[node] += members[node] * tree.chars[node]
        own[node] += tree.chars[node] if made else 0
        if node not in inner and node != goes_on:
            leaves[node] += 1
        up = tree.parent[node]
        if up < 0:
            continue
        members[up] += members[node]
        kids[up] += made
        leaves[up] += leaves[node]
        spent[up] += spent[node]
        own[up] += own[node]
        if smallest[node] is not None and (smallest[up] is None or smallest[node] < smallest[up]):
            smallest[up] = smallest[node]

    keys: dict[int, bytes] = {}
    for node in (*before, *after):
        if node not in keys:
            chain = keys[tree.parent[node]] + tree.turn[node].to_bytes(8, "big", signed=True) if node else b""
            keys[node] = hashlib.sha256(chain).digest()
    columns = {
        "part": [shard["part"][0].as_py()] * size,
        "piece": [shard["piece"][0].as_py()] * size,
        "depth": tree.depth,
        "turn_id": [t if i else None for i, t in enumerate(tree.turn)],
        "conv": smallest,
        "n_convs": members,
        "n_children": kids,
        "n_leaves": leaves,
        "spent": spent,
        "own": own,
        "ends_sha256": ends,
        "shared": [i in keys for i in range(size)],
        "key": [keys.get(i) for i in range(size)],
        "parent_key": [keys.get(p) for p in tree.parent],
        "parent_conv": [None if p < 0 or p in keys else smallest[p] for p in tree.parent],
    }
    types = [pa.int32()] * 2 + [pa.int64()] * 8 + [pa.string(), pa.bool_(), pa.binary(), pa.binary(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)], list(columns))
