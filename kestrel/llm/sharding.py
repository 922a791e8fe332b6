"""Sharding by sampled splitters: equal bytes per shard, groups kept in one shard. DataFrame functions only.

1. A size-weighted sample of keys is drawn: a row is taken with probability in
   proportion to its size (a keyed hash decides, so reruns agree); rows equal in key and id
   are one entry.
2. Quantiles of the sample are the splitters of many fine ranges (``fineness`` per
   shard). A key that several quantiles share is hot: it gets ranges of its own and is
   subdivided by the row's id, and equal ids by a hash of the row's place in the table. Other
   groups are never cut by a range.
3. One narrow pass sums rows and bytes per range. The driver places the ranges (their number is a
   parameter): a hot group that fits a shard goes whole to the emptiest one, the largest first;
   the other ranges follow each other on a line that fills what is left of each shard.
4. A row's shard is where the middle of its group lies on that line (of its range's part, for a
   group larger than a shard). Windows inside the ranges, over keys and sizes alone, number the
   rows; shard and slot are joined back by the row's place in the table, so texts move once and
   a hot key moves like any other. Slots count rows from 0 inside a shard.

Only groups larger than a shard's equal part are divided. Apart from single rows or hot groups that do
not fit what is left, a shard's bytes differ from the mean by at most one fine range.

Defined results: null keys, ids and sizes are allowed (null size: 0; a null key is one
group); rows equal in key and id are divided like others if their group is; an empty table gives
an empty result with the same columns; all input columns pass through, and the result's columns
get leading underscores where an input column has their name.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, ref, staged

#: Fine ranges per shard, and sampled keys per fine range.
FINENESS, SAMPLES = 32, 64
#: More ranges than that per shard where a range would hold more rows, up to so many in all.
RANGE_ROWS, MAX_RANGES = 1 << 22, 1 << 14
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
Bound = tuple[int, int, int]


def splitters(keys: DataFrame, ranges: int, seed: int, samples: int = SAMPLES) -> tuple[list[Bound], list[int]]:
    """Ascending (key, tie, spread) boundaries, about ``ranges``, from a size-weighted sample of rows (key, tie, size); and the hot keys.

    The sample's expected number of entries is at most ``ranges * samples``; only it reaches the driver.
    """
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    if not total:
        return [], []
    ranges = max(ranges, min(MAX_RANGES, rows // RANGE_ROWS))
    # a uniform number from the hash, compared with the expected number of draws
    uniform = F.pmod(F.xxhash64("key", "tie", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    rate = F.col("size") * (ranges * samples / float(total))
    entries = keys.groupBy("key", "tie").agg(F.sum("size").alias("size"))
    drawn = entries.where(uniform < rate).select("key", "tie", F.greatest(F.lit(1.0), rate).alias("w")).collect()
    drawn = sorted((r["key"], r["tie"], r["w"]) for r in drawn)
    if not drawn:
        return [], []
    upto = np.cumsum([w for *_, w in drawn])
    picked = Counter(drawn[i][:2] for i in np.searchsorted(upto, upto[-1] / ranges * np.arange(1, ranges)))
    often = Counter(key for key, _ in picked.elements())
    hot = sorted(key for key, n in often.items() if n > 1)
    # a hot key has ranges of its own; before any other key the boundary moves to its group's start
    bounds = {(key, LOWEST, LOWEST) for key in often} | {(key + 1, LOWEST, LOWEST) for key in hot if key < HIGHEST}
    for (key, tie), n in picked.items():
        if often[key] > 1:
            bounds |= {(key, tie, LOWEST + j * ((1 << 64) // n)) for j in range(n)}
    return sorted(bounds), hot


def place(bounds: list[Bound], hot: list[int], held: dict[int, tuple[int, int]], shards: int) -> tuple[list[tuple], list[float], list[int]]:
    """Where each range goes, from its (bytes, rows).

    Returns (range, bytes before, rows before, shard, slot) with shard and slot of ranges that go
    whole, else -1; the line's byte positions where shards 1, 2, ... begin; and each shard's rows of whole groups.
    """
    total = sum(n for n, _ in held.values())
    load, rows, fixed = [0] * shards, [0] * shards, {}
    groups = []
    for key in hot:
        first = bounds.index((key, LOWEST, LOWEST)) + 1
        last = bounds.index((key + 1, LOWEST, LOWEST)) if key < HIGHEST else len(bounds)
        own = range(first, last + 1)
        size = sum(held.get(r, (0, 0))[0] for r in own)
        if size * shards <= total:
            groups.append((size, key, own))
    emptiest = [(0, s) for s in range(shards)]
    for size, _, own in sorted(groups, reverse=True):
        before, s = heapq.heappop(emptiest)
        heapq.heappush(emptiest, (before + size, s))
        load[s] += size
        for r in own:
            fixed[r] = (s, rows[s])
            rows[s] += held.get(r, (0, 0))[1]
    line, n_bytes, n_rows = [], 0, 0
    for r in sorted(held):
        line.append((r, n_bytes, n_rows, *fixed.get(r, (-1, -1))))
        if r not in fixed:
            n_bytes, n_rows = n_bytes + held[r][0], n_rows + held[r][1]
    room = np.maximum(0.0, total / shards - np.array(load, float))
    starts = np.cumsum(room)[:-1] * (n_bytes / room.sum() if room.sum() else 0.0)
    return line, [float(x) for x in starts], rows


def _literals(values: list, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _table(spark: SparkSession, kinds: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A table of a few rows as literals."""
    lists = {c: _literals([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds.items())} if rows else {c: F.array().cast(f"array<{k}>") for c, k in kinds.items()}
    return spark.range(len(rows)).select(*[F.get(x, F.col("id").cast("int")).alias(c) for c, x in lists.items()])


def _search(n: int, below) -> Column:
    """How many of ``n`` ascending entries are ``below`` (a predicate of an entry's number), by binary search."""
    if not n:
        return F.lit(0)

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        going = s["lo"] < s["hi"]
        return F.struct(F.when(going & below(mid), mid + 1).otherwise(s["lo"]).alias("lo"), F.when(going & ~below(mid), mid).otherwise(s["hi"]).alias("hi"))

    first = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), first, step, lambda s: s["lo"])


def range_of(key: Column, tie: Column, spread: Column, bounds: list[Bound]) -> Column:
    """Number of boundaries at or below (key, tie, spread)."""
    lists = [_literals([b[i] for b in bounds], "bigint") for i in range(3)] if bounds else []

    def below(mid: Column) -> Column:
        k, t, a = (F.get(x, mid) for x in lists)
        return (k < key) | ((k == key) & ((t < tie) | ((t == tie) & (a <= spread))))

    return _search(len(bounds), below)


def shard(
    df: DataFrame,
    shards: int,
    key: Column,
    size: Column,
    id_col: str = "doc_id",
    seed: int = 42,
    fineness: int = FINENESS,
) -> DataFrame:
    """``df`` plus ``shard`` (0..shards-1) and ``slot`` (0, 1, 2, ... inside each shard).

    Rows with equal ``key`` (any expression that can be hashed) share a shard unless they are more
    than a shard's equal part. ``df`` is read twice and must be a written table, whose rows keep their places.
    """
    spark = df.sparkSession
    shard_col, slot_col, at = fresh(df, "shard", "slot", "s_at")
    numbered = df.withColumn(at, F.monotonically_increasing_id())
    lean = numbered.select(F.xxhash64(key).alias("key"), F.xxhash64(ref(id_col)).alias("tie"), F.col(at).alias("at"), F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("size"))
    lean = staged(lean.withColumn("spread", F.xxhash64("at")), "shard-keys")
    bounds, hot = splitters(lean, shards * fineness, seed)
    ranged = lean.withColumn("range", range_of(F.col("key"), F.col("tie"), F.col("spread"), bounds))
    held = {r["range"]: (r["bytes"], r["rows"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    line, begins, whole = place(bounds, hot, held, shards)

    inside = Window.partitionBy("range").orderBy("key", "tie", "spread", "at")
    group = Window.partitionBy("range", "key")
    rows = ranged.withColumn("pos", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("rank", F.row_number().over(inside) - 1)
    middle = (F.min("pos").over(group) + F.max(F.col("pos") + F.col("size")).over(group)) / 2
    where = _table(spark, {"in_range": "int", "bytes": "bigint", "rows": "bigint", "fixed": "int", "base": "bigint"}, line)
    rows = rows.withColumn("middle", middle).join(F.broadcast(where), F.col("range") == F.col("in_range"))  # one row per range
    x = F.col("bytes") + F.col("middle")
    begin = _literals(begins, "double")
    cell = _search(len(begins), lambda mid: F.get(begin, mid) <= x)
    goes_whole = F.col("fixed") >= 0
    placed = rows.select("at", F.when(goes_whole, F.col("fixed")).otherwise(cell).alias("shard"), goes_whole.alias("whole"), (F.when(goes_whole, F.col("base")).otherwise(F.col("rows")) + F.col("rank")).alias("row"))
    placed = staged(placed, "shard-rows")

    firsts = placed.where("NOT whole").groupBy("shard").agg(F.min("row").alias("first"))
    extra = _table(spark, {"in_shard": "int", "ahead": "bigint"}, list(enumerate(whole)))
    firsts = firsts.join(F.broadcast(extra), F.col("shard") == F.col("in_shard")).select("in_shard", (F.col("ahead") - F.col("first")).alias("shift"))  # one row per shard
    slots = placed.join(F.broadcast(firsts), F.col("shard") == F.col("in_shard"), "left")
    slot = F.col("row") + F.when(F.col("whole"), 0).otherwise(F.col("shift"))
    found = slots.select(F.col("at").alias(f"{at}_"), F.col("shard").alias(f"{at}_shard"), slot.cast("long").alias(f"{at}_slot"))
    joined = numbered.join(found, F.col(at) == F.col(f"{at}_"))
    return joined.select(*[ref(c) for c in df.columns], F.col(f"{at}_shard").cast("int").alias(shard_col), F.col(f"{at}_slot").alias(slot_col))
