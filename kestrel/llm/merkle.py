"""Merkle dataset manifest by nested-struct rollup.

Rows are leaves of one hash tree per group; the groups' roots are the leaves of one more tree. A
level hashes every ``fanout`` consecutive nodes (the last run may hold fewer, even one) until one
node is left. ``manifest`` gives every row the proof of its leaf; ``fold`` recomputes the root from
a leaf and its proof, so a row is verified without any other row.

Rows are ranked within their group by range partitions with one offset for each partition and
group. A rank is written in digits of base ``fanout``; a block holds the ranks that agree in all
but the last ``DIGITS`` digits. Within blocks the digit columns are grouped away one after the
other, from the last to the first, and each step nests the child structs in their parent: one
shuffle by block serves all steps. The block's nodes are then the next round's leaves, each round
with ``fanout ** DIGITS`` times fewer rows. On the way back a block meets its own path from the
round above by a union and one grouping, and one transform and explode emits its children's proofs;
there is no join between leaves and tree nodes.

Only hashes and kept columns are shuffled, never texts. A block is at most ``fanout ** DIGITS``
rows whatever the groups, so a group that holds most rows is as many blocks as it needs; the driver
receives the largest group's size and the root.

Defined results: a null field counts as ``-`` in a leaf, a null group is a group and comes first;
ranks go by the order columns, nulls first, then by the leaf, and repeated rows are leaves of their
own; a group of one row has its leaf as subroot, one group its subroot as root; an empty table
gives an empty result; kept columns pass through under their names whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ref, staged

FANOUT = 2
#: Digit columns of a block: 256 leaves at fanout 2.
DIGITS = 8
PROOF = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    """H: lowercase hex SHA-256."""
    return F.sha2(text, 256)


def leaf(*fields: Column) -> Column:
    """H over the fields, each ``-`` if null, else its UTF-8 length, a colon and its text."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def fold(start: Column, proof: Column) -> Column:
    """The root that ``start`` and its proof lead to."""
    return F.aggregate(proof, start, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def siblings(proof: Column) -> Column:
    """All sibling hashes of a proof in one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(df: DataFrame, leaf: Column, group: Column, order: Sequence[Column], keep: Sequence[str] = (), fanout: int = FANOUT, digits: int = DIGITS) -> DataFrame:
    """``keep`` columns plus leaf, subroot, root and proof (array of left and right siblings, joined)."""
    rows = df.select(group.alias("g"), F.struct(*order).alias("o"), leaf.alias("hash"), F.struct(leaf.alias("leaf"), *[ref(c).alias(f"keep{i}") for i, c in enumerate(keep)]).alias("item"))
    levels = _grow(staged(rows, "merkle-leaves"), fanout, digits)
    tops = levels[-1].select(F.lit(0).alias("g"), F.struct("g").alias("o"), "hash", F.struct(F.col("g").alias("group"), F.col("hash").alias("subroot")).alias("item"))
    groups = _grow(staged(tops, "merkle-subroots"), fanout, digits)
    found = groups[-1].select("hash").first()
    root = F.lit(found and found[0]).cast("string")

    top = groups[-1].withColumn("above", F.array().cast(PROOF))
    paths = _proofs(groups, top, fanout, digits).select(F.col("item.group").alias("g"), F.lit(0).cast("long").alias("rank"), "proof", F.col("item.subroot").alias("subroot"))
    out = _proofs(levels, _meet(levels[-1], paths), fanout, digits)
    return out.select(*[F.col(f"item.keep{i}").alias(c) for i, c in enumerate(keep)], F.col("item.leaf").alias("leaf"), "subroot", root.alias("root"), "proof")


def _grow(leaves: DataFrame, fanout: int, digits: int) -> list[DataFrame]:
    """The written blocks of each round, the last with one block for each group."""
    nodes = _ranked(leaves)
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while True:
        blocks = staged(_blocks(nodes, fanout, digits), "merkle-blocks")
        levels.append(blocks)
        if largest <= fanout**digits:
            return levels
        largest = -(-largest // fanout**digits)
        nodes = blocks.select("g", F.col("block").alias("rank"), F.expr(f"(n - 1) div {fanout**digits} + 1").alias("n"), "hash", F.struct(F.col("block").alias("rank")).alias("item"))


def _ranked(leaves: DataFrame) -> DataFrame:
    """g, rank (from 0) and n (rows) within the group, hash, item. ``leaves`` is a written table."""
    numbered = leaves.withColumn("at", F.monotonically_increasing_id())  # tells repeated rows apart
    keys = ["g", "o", "hash", "at"]
    line = staged(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("g", "hash", "item", F.monotonically_increasing_id().alias("pos")), "merkle-ranks")
    line = line.withColumn("part", F.shiftright("pos", 33))
    runs = line.groupBy("g", "part").agg(F.min("pos").alias("first"), F.count("*").alias("rows"))
    group = Window.partitionBy("g")  # one row for each range partition that the group reaches into
    before = F.coalesce(F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("g").alias("of"), F.col("part").alias("in_part"), (before - F.col("first")).alias("shift"), F.sum("rows").over(group).alias("n"))
    joined = line.join(runs, (F.col("part") == F.col("in_part")) & F.col("g").eqNullSafe(F.col("of")))
    return joined.select("g", (F.col("pos") + F.col("shift")).alias("rank"), "n", "hash", "item")


def _blocks(nodes: DataFrame, fanout: int, digits: int) -> DataFrame:
    """g, block, n, hash and the nested children of each block."""
    digit = [F.expr(f"int(rank div {fanout**j} % {fanout})").alias(f"d{j}") for j in range(digits)]
    rows = nodes.select("g", F.expr(f"rank div {fanout**digits}").alias("block"), "n", *digit, "hash", "item")
    rows = rows.repartition("g", "block")
    inner = "item"
    for j in range(digits):
        left = [f"d{k}" for k in range(j + 1, digits)]
        child = F.struct(F.col(f"d{j}").alias("d"), "hash", inner)
        rows = rows.groupBy("g", "block", "n", *left).agg(F.collect_list(child).alias("kids"))
        kids = F.array_sort("kids", lambda a, b: a["d"] - b["d"])
        rows = rows.select("g", "block", "n", *left, kids.alias("kids"))
        node = F.when(F.col("n") > fanout**j, digest(F.array_join(F.col("kids")["hash"], ""))).otherwise(F.col("kids")[0]["hash"])
        rows = rows.select("g", "block", "n", *left, node.alias("hash"), "kids")
        inner = "kids"
    return rows


def _meet(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Every block with its path above it (``paths``: g, rank, proof, subroot)."""
    own = blocks.select("g", "block", F.struct("n", "kids").alias("tree"))
    path = paths.select("g", F.col("rank").alias("block"), F.col("proof").alias("above"), *[c for c in paths.columns if c == "subroot"])
    both = own.unionByName(path, allowMissingColumns=True).groupBy("g", "block")
    out = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("tree", *path.columns[2:])])
    return out.select("g", "block", "tree.n", "tree.kids", *path.columns[2:])


def _proofs(levels: list[DataFrame], top: DataFrame, fanout: int, digits: int) -> DataFrame:
    """One row for each leaf of the first round: g, item, proof (and subroot)."""
    carried = [c for c in top.columns if c == "subroot"]
    rows = top
    for depth in range(len(levels) - 1, -1, -1):
        found = rows.select("g", *carried, F.explode(_children(F.col("kids"), F.col("n"), F.col("above"), fanout, digits)).alias("x"))
        found = found.select("g", *carried, "x.item", "x.proof")
        if depth == 0:
            return found
        rows = _meet(levels[depth - 1], found.select("g", F.col("item.rank").alias("rank"), "proof", *carried))
    raise ValueError("no levels")


def _children(kids: Column, n: Column, above: Column, fanout: int, digits: int) -> Column:
    """All items of a block, each with its proof."""
    height = F.lit(0)
    for j in range(digits):
        height = height + (n > fanout**j).cast("int")

    def walk(kids: Column, j: int, steps: list[Column]) -> Column:
        hashes = kids["hash"]

        def visit(kid: Column, i: Column) -> Column:
            step = F.struct(F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"), F.array_join(F.slice(hashes, i + 2, F.size(hashes)), "").alias("right"))
            path = [step, *steps]
            if j == 0:
                return F.struct(kid["item"].alias("item"), F.concat(F.slice(F.array(*path), F.lit(1), height), above).alias("proof"))
            return walk(kid["kids"], j - 1, path)

        found = F.transform(kids, visit)
        return found if j == 0 else F.flatten(found)

    return walk(kids, digits - 1, [])
