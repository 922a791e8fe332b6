"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. ``targets``: each source's target size from its weight, at most ``max_repeats``
   times its own size; what is cut off is shared out again by weight.
2. Each source is put into a fixed random order (a keyed hash of the row). A
   two-level prefix sum (slices of the hash, then rows inside a slice) gives every
   row its exact position in words without gathering a source anywhere.
3. The order is cut into blocks of ``block_size`` words. A source's target is its
   quota: so many whole passes, then blocks from the start of the order, then, in
   order, the rows of the next ``LOOK`` blocks that still fit.
4. The quotas of all sources (block copies) are split among ``shards`` outputs by a
   binary tree. Every node draws from a multivariate hypergeometric law how many
   block copies of each source go left, so each shard is a random share and the
   counts add up exactly. Block copies reach their leaf through a keyed permutation
   of ``0..quota-1``: leaves get disjoint permuted blocks.
5. Inside a shard rows are ordered by a keyed hash.

A node's draw is seeded by the node, a row's hash by the row, so reruns and
retried tasks agree. Equal rows are told apart by a repeat number, so they get places of their
own. The driver holds one number per source, not per row.

Defined results: a null source is a source of its own, last in order; a null or
empty text has size 0 and no words are taken from it (``copies`` 0, unless its
source is taken whole); repeated rows count each in ``plan`` (``mix`` draws rows equal in id, source
and text together); an empty table gives an empty mix; a mix of 10^9 block copies or more is
refused: a larger ``block_size`` makes fewer of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK, as_bytes, fresh, mix64, ref, spans, staged

BLOCK_WORDS = 1 << 16
SLICE_ROWS = 1 << 11
#: Blocks that are searched for rows to fill the end of a quota.
LOOK = 4
#: Equal rows that are numbered in one task.
REPEATS = 1 << 12


def word_counts(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` without its text, with the text's number of words (null: 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column(batch.num_columns - 1), BLOCK):
                part = batch.slice(lo, hi - lo)
                n = np.array([len(t.split()) for t in as_bytes(part.columns[-1])], np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n)], names=[*batch.schema.names[:-1], out])

    kept = [f for f in df.schema.fields if f.name != text_col]
    return df.select(*[ref(f.name) for f in kept], ref(text_col)).mapInArrow(run, T.StructType([*kept, T.StructField(out, T.LongType())]))


def fill_targets(sizes: list[int], weights: list[float], total: float, max_repeats: float) -> list[float]:
    """Targets in proportion to the weights, none above ``max_repeats`` times its size; the excess is reshared until none is above."""
    target, open_ = [0.0] * len(sizes), {i for i in range(len(sizes)) if sizes[i] > 0}
    left = min(float(total), max_repeats * float(sum(sizes)))
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if share * weights[i] > max_repeats * sizes[i]}
        for i in full or open_:
            target[i] = float(max_repeats * sizes[i]) if full else share * weights[i]
        left -= sum(target[i] for i in full)
        open_ = open_ - full if full else set()
    return target


class SplitTree:
    """Leaf of every block copy: a pure function of the quotas, the number of shards and the seed."""

    def __init__(self, quotas: list[int], shards: int, seed: int):
        if sum(quotas) >= 1_000_000_000:  # the generator's range
            raise ValueError(f"{sum(quotas)} block copies: take a larger block_size")
        self.quotas, self.shards, self.seed = np.array(quotas, np.int64), shards, seed
        self._left: dict[tuple[int, int], np.ndarray] = {}

    def left(self, lo: int, hi: int, counts: np.ndarray) -> np.ndarray:
        """How many copies of each source the node over shards lo..hi-1 sends to its left half."""
        if (lo, hi) not in self._left:
            rng = np.random.Generator(np.random.Philox(key=[self.seed, (lo << 32) | hi]))
            draws, rest = int(counts.sum()) * ((lo + hi) // 2 - lo) // (hi - lo), int(counts.sum())
            out = np.zeros_like(counts)
            for s, c in enumerate(counts):  # one source after the other: the law's conditional form
                rest -= int(c)
                out[s] = _hypergeometric(rng, int(c), rest, draws)
                draws -= int(out[s])
            self._left[lo, hi] = out
        return self._left[lo, hi]

    def leaves(self, source: np.ndarray, copy: np.ndarray) -> np.ndarray:
        """Shard of each (source, number of the copy among the source's quota)."""
        at = permute(copy, self.quotas[source], self.seed + 1 + source)
        out = np.zeros(len(at), np.int64)
        todo = [(0, self.shards, self.quotas, np.arange(len(at)))] if len(at) else []
        while todo:
            lo, hi, counts, rows = todo.pop()
            if hi - lo == 1:
                out[rows] = lo
                continue
            mid, left = (lo + hi) // 2, self.left(lo, hi, counts)
            goes = at[rows] < left[source[rows]]
            at[rows[~goes]] -= left[source[rows[~goes]]]
            todo += [x for x in ((lo, mid, left, rows[goes]), (mid, hi, counts - left, rows[~goes])) if len(x[3])]
        return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if draws <= 0 or good <= 0:
        return 0
    if bad <= 0:
        return min(good, draws)
    return int(rng.hypergeometric(good, bad, draws))


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..n-1 (four Feistel rounds, walked until the value is below n)."""
    half = np.array([max(1, (int(v - 1).bit_length() + 1) // 2) for v in n], np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, key, todo = x.astype(np.uint64), key.astype(np.uint64), np.arange(len(x))
    while len(todo):
        a, b, m = out[todo] >> half[todo], out[todo] & low[todo], low[todo]
        for r in range(4):
            a, b = b, a ^ (mix64(b + mix64(key[todo] * np.uint64(4) + np.uint64(r))) & m)
        out[todo] = (a << half[todo]) | b
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def cycle_weights(names: list[str | None], cycle: tuple[float, ...] = (1, 2, 3)) -> dict[str | None, float]:
    """Weights by the sources' code-point order, null last."""
    order = sorted((n for n in names if n is not None)) + [None] * (None in names)
    return {n: float(cycle[i % len(cycle)]) for i, n in enumerate(order)}


def _numbered(rows: DataFrame, repeat: str) -> DataFrame:
    """``rows`` with a number from 0 for each group of equal rows.

    Equal rows are counted (on the map side first) and unfolded again, many of them by
    several tasks, so the numbers depend on the rows alone.
    """
    counted = rows.groupBy(*[ref(c) for c in rows.columns]).agg((F.count("*") - 1).alias(repeat))
    parts = counted.withColumn("m_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col(repeat), F.lit(REPEATS).cast("long"))))
    dealt = parts.repartition(*[ref(c) for c in rows.columns], F.col("m_part"))
    return dealt.withColumn(repeat, F.explode(F.sequence("m_part", F.least(F.col(repeat), F.col("m_part") + REPEATS - 1)))).drop("m_part")


def plan(
    sized: DataFrame,
    weights=cycle_weights,
    share: float = 1.0,
    max_repeats: float = 3,
    shards: int = 16,
    seed: int = 42,
    block_size: int = BLOCK_WORDS,
    source_col: str = "source",
    size_col: str = "size",
    order: Column | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``sized`` plus source_size, target, copies (array of the shards that get a copy, one entry per copy).

    ``sized`` is read several times: pass a written table. ``weights`` maps the list
    of source names to a weight each. The list of sources is the mix's definition
    and the only thing the driver holds.
    """
    if clash := [c for c in sized.columns if c.lower().startswith("m_") or c.lower() in ("source_size", "target", "copies")]:
        raise ValueError(f"leave {clash} out of the plan's input; mix() carries other columns")
    spark = sized.sparkSession
    repeat = "m_repeat"
    order = order if order is not None else F.xxhash64(*[ref(c) for c in sized.columns], F.lit(seed), F.col(repeat))
    totals = sized.groupBy(ref(source_col).alias("s")).agg(F.sum(ref(size_col)).cast("long").alias("n"), F.count("*").alias("rows")).collect()
    names = [r["s"] for r in totals]
    weight = weights(names)
    names.sort(key=lambda x: (x is None, x or ""))
    size_of = {r["s"]: int(r["n"] or 0) for r in totals}
    sizes = [size_of[n] for n in names]
    target = fill_targets(sizes, [weight[n] for n in names], share * sum(sizes), max_repeats)
    most = max([r["rows"] for r in totals], default=0)
    slices = max(1, -(-most // slice_rows))

    sources = spark.createDataFrame(
        [(n, i, sizes[i], target[i]) for i, n in enumerate(names)], "m_source string, m_index int, source_size long, target double"
    )
    rows = _numbered(sized, repeat).withColumn("m_key", order).withColumn("m_slice", F.pmod(F.shiftrightunsigned("m_key", 16), F.lit(slices))).drop(repeat)
    within = Window.partitionBy(ref(source_col), F.col("m_slice")).orderBy("m_key").rowsBetween(Window.unboundedPreceding, -1)  # rows with one key are equal
    slice_totals = rows.groupBy(ref(source_col).alias("m_source"), F.col("m_slice").alias("m_at")).agg(F.sum(ref(size_col)).alias("m_n"))
    ahead = Window.partitionBy("m_source").orderBy("m_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_totals.select("m_source", "m_at", F.coalesce(F.sum("m_n").over(ahead), F.lit(0)).alias("m_before"))
    placed = (
        rows.withColumn("m_pos", F.coalesce(F.sum(ref(size_col)).over(within), F.lit(0)))
        .join(offsets, ref(source_col).eqNullSafe(F.col("m_source")) & (F.col("m_slice") == F.col("m_at")))
        .withColumn("m_pos", F.col("m_pos") + F.col("m_before"))
        .drop("m_source", "m_at", "m_before", "m_slice")
        .join(F.broadcast(sources), ref(source_col).eqNullSafe(F.col("m_source")))  # one row per source
        .drop("m_source")
    )
    # whole passes, then the blocks before the one where the quota ends, then what fits of that block
    size = ref(size_col)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.withColumn("m_passes", passes)
    rest = F.col("target") - F.col("m_passes") * F.col("source_size")
    placed = placed.withColumn("m_rest", rest).withColumn("m_cut", F.floor(F.col("m_rest") / block_size) * block_size)
    whole = (F.col("m_rest") > 0) & (F.col("m_pos") + size <= F.col("m_cut"))
    edge = (F.col("m_rest") > 0) & ~whole & (size > 0) & (F.col("m_pos") < F.col("m_cut") + LOOK * block_size)
    placed = placed.withColumn("m_copies", F.col("m_passes") + whole.cast("long"))
    plain, last = placed.where(~edge), placed.where(edge)

    def fit(rows: pa.Table) -> pa.Table:
        """Rows of one source in the blocks after its last whole one (a bounded group): in order, each that still fits."""
        rows = rows.sort_by([("m_pos", "ascending"), ("m_key", "ascending")])
        room, take = rows["m_rest"][0].as_py() - rows["m_pos"][0].as_py(), []
        for n in rows[size_col].to_pylist():
            take.append(int(n <= room))
            room -= n if n <= room else 0
        at = rows.schema.get_field_index("m_copies")
        return rows.set_column(at, rows.schema.field(at), pc.add(rows["m_copies"], pa.array(take, pa.int64())))

    placed = plain.unionByName(last.groupBy("m_index").applyInArrow(fit, last.schema))

    per_pass = [-(-s // block_size) for s in sizes]  # blocks of one pass over a source
    quotas = []  # block copies a source gives
    for s, t, p in zip(sizes, target, per_pass, strict=True):
        passes_, left = divmod(t, s) if s else (0, 0.0)
        quotas.append(int(passes_) * p + (int(left // block_size) + 1 if left else 0))
    SplitTree(quotas, shards, seed)  # refuses too many copies here, not in a task

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, blocks_of = SplitTree(quotas, shards, seed), np.array(per_pass, np.int64)
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            copies, source, block = get("m_copies").astype(np.int64), get("m_index").astype(np.int64), get("m_pos").astype(np.int64) // block_size
            ends = (get("m_cut") // block_size).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(copies)])
            row = np.repeat(np.arange(len(copies)), copies)
            nth = np.arange(len(row)) - bounds[row]
            # rows without words at the very end of the order start no block of their own
            of = np.minimum(block[row], blocks_of[source[row]] - 1)
            of = np.where(nth == get("m_passes")[row], np.minimum(of, ends[row]), of)  # a fill counts for the block it fills
            at = nth * blocks_of[source[row]] + of
            shard = tree.leaves(source[row], at) if len(row) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(shard, pa.int64()))
            kept = [i for i, n in enumerate(batch.schema.names) if n in out_names]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], lists], names=[*[batch.schema.names[i] for i in kept], "copies"])

    fields = [f for f in placed.schema.fields if f.name in {*sized.columns, "source_size", "target"}]
    out_names = {f.name for f in fields}
    return placed.mapInArrow(deal, T.StructType([*fields, T.StructField("copies", T.ArrayType(T.LongType()))]))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42, **options) -> DataFrame:
    """The mixed rows: every column of ``df``, one row per copy, plus ``mix_shard`` and ``mix_order`` (the order inside the shard).

    The plan is made on (id, source, hash of the text, size) and joined back once; rows with
    the same id, source and text are copies of one row and are drawn together.
    """
    size, digest, shard, order = fresh(df, "mix_size", "mix_digest", "mix_shard", "mix_order")
    lean = word_counts(df.select(ref(id_col), ref(source_col), F.xxhash64(ref(text_col)).alias(digest), ref(text_col)), text_col, size)
    keys = [id_col, source_col, digest]
    one = staged(lean, "mix-sizes").groupBy(*[ref(k) for k in keys]).agg(F.sum(ref(size)).alias(size))
    planned = plan(staged(one, "mix-rows"), source_col=source_col, size_col=size, seed=seed, **options)
    drawn = fresh(df, "mix_id", "mix_source", "mix_key")
    copies = deal_out(planned.select(*[ref(k).alias(p) for k, p in zip(keys, drawn, strict=True)], "copies"), [drawn[0], drawn[2]], seed, shard, order)
    rows = df.withColumn(digest, F.xxhash64(ref(text_col)))
    same = [ref(k).eqNullSafe(ref(p)) for k, p in zip(keys, drawn, strict=True)]
    return rows.join(copies, same[0] & same[1] & same[2]).drop(*drawn, digest)


def deal_out(planned: DataFrame, keys: list[str], seed: int = 42, shard: str = "mix_shard", order: str = "mix_order") -> DataFrame:
    """One row per copy of a plan: its columns without ``copies``, its shard, and its place in the shard's order (a hash of ``keys`` and the shard)."""
    rows = planned.where(F.size("copies") > 0).withColumn(shard, F.explode("copies")).drop("copies")
    return rows.withColumn(order, F.xxhash64(*[ref(k) for k in keys], ref(shard), F.lit(seed)))


def write_shards(mixed: DataFrame, path: str, shard_col: str = "mix_shard", order_col: str = "mix_order") -> None:
    """Write the mix, one folder per shard, rows inside a shard shuffled by ``order_col``.

    A shard's rows are dealt to as many tasks as its size asks for, by ranges of the
    order, so reading a shard's files by name gives the shuffled order.
    """
    dealt = mixed.repartitionByRange(ref(shard_col), ref(order_col)).sortWithinPartitions(ref(shard_col), ref(order_col))
    dealt.drop(order_col).write.partitionBy(shard_col).parquet(path)
