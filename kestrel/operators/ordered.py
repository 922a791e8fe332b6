"""Joins and windows along an order: as-of join, interval overlap join, running sums and ranks.

Spark's own forms of these put all rows of a key (or, without a key, the whole table) in one
task, or compare all pairs. Here the order itself is cut: by time buckets, by bins of interval
lengths, or by range partitions. A small row per piece carries over what the next piece needs.
So neither a hot key nor a global order is one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, TimestampNTZType, TimestampType

from ..session import scratch_path

DAY = 86_400_000_000


def position(df: DataFrame, name: str) -> Column:
    """A date, timestamp or integral column as a long: microseconds for times, the number else."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("long") * DAY
    if isinstance(kind, IntegralType):
        return col.cast("long")
    raise TypeError(f"{name} is {kind.simpleString()}; a date, timestamp or integral column is needed")


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, payload: Sequence[str],
              bucket: int, strict: bool = False, tolerance: int | None = None) -> DataFrame:
    """Every left row with the ``payload`` of the last right row of its key at or before it.

    ``strict``: before it. ``tolerance``: at most so far before. ``bucket`` and ``tolerance`` are in the units
    of :func:`position`. Among right rows of one key and time the one with the largest payload
    counts. Left rows without a match, with a null key or a null time have null payloads.

    Rows are windowed by (key, bucket of time); the last right row of each bucket is carried
    to the key's later buckets by a second window over one row per bucket. So a hot key is as many
    tasks as it has buckets, and each event is shuffled once.
    """
    wide = F.struct(*[F.col(f"`{c}`") for c in payload])
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in payload]

    def placed(df: DataFrame, at: str, order: int, **columns: Column) -> tuple[DataFrame, DataFrame]:
        """Rows with key and time as events, and the others."""
        usable = F.col(f"`{at}`").isNotNull()
        for c in on:
            usable = usable & F.col(f"`{c}`").isNotNull()
        when = position(df, at)
        events = df.where(usable).select(F.struct(*on).alias("key"), (when - F.pmod(when, F.lit(bucket))).alias("bucket"), when.alias("at"),
                                         F.lit(order).alias("order"), *[c.alias(n) for n, c in columns.items()])
        return events, df.where(~usable)

    rights, _ = placed(right, right_at, 1, found=wide)
    lefts, unplaced = placed(left, left_at, 0 if strict else 2, row=F.struct("*"))  # among the right rows of its time
    events = lefts.unionByName(rights, allowMissingColumns=True)
    hit = F.when(F.col("order") == 1, F.struct("at", "found"))
    inside = Window.partitionBy("key", "bucket").orderBy("at", "order", "found").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = events.select("key", "bucket", "at", "order", "row", F.last(hit, ignorenulls=True).over(inside).alias("own")).where("order <> 1")

    per_bucket = events.groupBy("key", "bucket").agg(F.max(hit).alias("last"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(F.col("key").alias("c_key"), F.col("bucket").alias("c_bucket"), F.last("last", ignorenulls=True).over(before).alias("carried"))
    same = (F.col("key") == F.col("c_key")) & (F.col("bucket") == F.col("c_bucket"))
    joined = own.join(carried.where("carried IS NOT NULL"), same, "left")
    match = F.coalesce("own", "carried")
    if tolerance is not None:
        match = F.when(F.col("at") - match["at"] <= tolerance, match)
    return joined.select("row.*", *[match["found"][c].alias(c) for c in payload]).unionByName(unplaced.select("*", *nothing))


#: Bin sizes of :func:`overlap_join` relative to its smallest bin.
LEVELS = tuple(8**k for k in range(7))


def overlap_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], smallest: int,
                 on: Sequence[tuple[str, str]] = (), levels: Sequence[int] = LEVELS) -> DataFrame:
    """All pairs whose half-open spans ``[from, to)`` overlap (and whose ``on`` columns are equal).

    The inputs must not share column names. Empty spans and spans with a null end match nothing.

    A span belongs to the first level whose bins (``smallest`` times the level's factor) are as long
    as itself, so it touches at most two bins there; longer spans use as many bins of the last
    level as they need. Two spans meet at the higher of their two levels, in the bin where their
    overlap starts and in no other: an exact rule, so no pair is found twice and nothing is
    deduplicated. At each level the spans that belong there meet the other side's spans of that
    and lower levels, never lower ones among themselves, whose bins would be far too wide. Only
    levels that the other side has are listed (one small job finds them). The join is an equi-join
    on (``on``, side and level, bin) that adaptive execution can split; no nested loop.
    """
    n = len(levels)

    def placed(df: DataFrame, span: tuple[str, str], tag: str) -> DataFrame:
        lo, hi = (position(df, c) for c in span)
        own = F.lit(n - 1)
        for k in range(n - 2, -1, -1):
            own = F.when(hi - lo <= smallest * levels[k], k).otherwise(own)
        return df.select(F.struct("*").alias(f"{tag}_row"), lo.alias(f"{tag}_lo"), hi.alias(f"{tag}_hi"), own.alias("own")).where(f"{tag}_lo < {tag}_hi")

    a, b = placed(left, left_span, "l"), placed(right, right_span, "r")
    found = a.select(F.lit("l").alias("side"), "own").unionByName(b.select(F.lit("r").alias("side"), "own")).distinct().collect()  # at most 2 x levels
    in_left, in_right = (sorted(r["own"] for r in found if r["side"] == side) for side in "lr")

    # Where the left span's level is the higher one or both are equal, the pair meets at place = level; else at n + level.
    left_places = {k: [k] * any(r <= k for r in in_right) + [n + r for r in in_right if r > k] for k in range(n)}
    right_places = {k: [n + k] * any(x < k for x in in_left) + [x for x in in_left if x >= k] for k in range(n)}

    def size(place: Column) -> Column:
        return F.element_at(F.array(*[F.lit(smallest * f).cast("long") for f in levels]), F.pmod(place, F.lit(n)) + 1)

    def listed(df: DataFrame, tag: str, places: dict[int, list[int]]) -> DataFrame:
        table = F.array(*[F.array(*[F.lit(p) for p in places[k]]).cast("array<int>") for k in range(n)])
        rows = df.select(f"{tag}_row", f"{tag}_lo", f"{tag}_hi", F.explode(F.element_at(table, F.col("own") + 1)).alias(f"{tag}_place"))
        wide = size(F.col(f"{tag}_place"))
        first, last = (x - F.pmod(x, wide) for x in (F.col(f"{tag}_lo"), F.col(f"{tag}_hi") - 1))  # a bin goes by its start
        return rows.select("*", F.explode(F.sequence(first, last, wide)).alias(f"{tag}_bin"))

    start = F.greatest("l_lo", "r_lo")
    cond = (F.col("l_place") == F.col("r_place")) & (F.col("l_bin") == F.col("r_bin"))
    cond = cond & (start < F.least("l_hi", "r_hi")) & (start - F.pmod(start, size(F.col("l_place"))) == F.col("l_bin"))
    for x, y in on:
        cond = cond & (F.col("l_row")[x] == F.col("r_row")[y])
    return listed(a, "l", left_places).join(listed(b, "r", right_places), cond).select("l_row.*", "r_row.*")


#: A column to order by: its name (ascending, nulls first), or the name and "desc" (nulls last).
Order = str | tuple[str, str]


def _by(order: Sequence[Order]) -> list[tuple[str, bool]]:
    return [(o, False) if isinstance(o, str) else (o[0], o[1] == "desc") for o in order]


def _sorting(names: Sequence[str], order: Sequence[Order]) -> list[Column]:
    return [F.col(n).desc_nulls_last() if down else F.col(n).asc_nulls_first() for n, (_, down) in zip(names, _by(order), strict=True)]


def running(df: DataFrame, order: Sequence[Order], keys: Sequence[str] = (), sums: Mapping[str, Column] | None = None,
            number: str = "row_number", unique: bool = False, stable: bool = False) -> DataFrame:
    """``df`` with ``number`` (1, 2, ... along ``order``, per key) and running sums up to each row.

    Rows equal in ``order`` are told apart by a hash of the row; equal rows are interchangeable.
    ``unique``: (keys, order) has no ties. ``stable``: ``df`` is read from files as they are; other
    inputs with ties are written first, because a repeated task could number their rows anew.

    Rows are range-partitioned by (keys, order), so neither the whole order nor a hot key is one
    task, and written sorted to the shared folder. Each partition adds its own rows; the totals of
    the partitions before it come from a window over one row per (partition, key).
    """
    sums = dict(sums or {})
    names = [f"s{i}" for i in range(len(sums))]
    ties = [] if unique else ["tie", "at"]
    cols = [f"o{i}" for i in range(len(order))]
    rows = df.select(F.struct("*").alias("row"), F.struct(*[F.col(f"`{k}`") for k in keys], F.lit(0).alias("_")).alias("key"),
                     *[c.alias(n) for n, c in zip(names, sums.values(), strict=True)],
                     *[F.col(f"`{o}`").alias(c) for c, (o, _) in zip(cols, _by(order), strict=True)])
    if ties:
        rows = rows if stable else _written(rows)
        rows = rows.select("*", F.xxhash64("row").alias("tie"), F.monotonically_increasing_id().alias("at"))
    by = ["key", *_sorting(cols, order), *ties]
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    line = _written(sorted_.select("row", "key", *names, F.monotonically_increasing_id().alias("pos")))
    line = line.withColumn("part", F.shiftright("pos", 33))

    totals = line.groupBy("key", "part").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("rows"), *[F.sum(n).alias(n) for n in names])
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first") + 1
    start = totals.select(F.col("key").alias("b_key"), F.col("part").alias("b_part"), shift.alias("shift"), *[F.sum(n).over(before).alias(f"b_{n}") for n in names])
    inside = Window.partitionBy("key", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.select("row", "key", "part", "pos", *[F.sum(n).over(inside).alias(n) for n in names])
    joined = line.join(start, (F.col("key") == F.col("b_key")) & (F.col("part") == F.col("b_part")))
    # null only where all values so far are null, as in a window sum
    both = [F.coalesce(F.col(n) + F.col(f"b_{n}"), n, f"b_{n}").alias(c) for c, n in zip(sums, names, strict=True)]
    return joined.select("row.*", (F.col("pos") + F.col("shift")).alias(number), *both)


def ranks(df: DataFrame, order: Sequence[Order], keys: Sequence[str] = (), rank: str = "rank", dense: str = "dense_rank") -> DataFrame:
    """``df`` with the rank (ties share one, with gaps) and dense rank along ``order``, per key.

    Rows are first counted per (keys, order value), on the map side too, so ties of any number are
    one row; the counts are summed by :func:`running` and joined back to the rows.
    """
    cols = [f"o{i}" for i in range(len(order))]
    rows = df.select(F.struct("*").alias("row"), F.struct(*[F.col(f"`{k}`") for k in keys], F.lit(0).alias("_")).alias("key"),
                     *[F.col(f"`{o}`").alias(c) for c, (o, _) in zip(cols, _by(order), strict=True)])
    values = rows.groupBy("key", *cols).agg(F.count(F.lit(1)).alias("n"))
    along = [(c, "desc") if down else c for c, (_, down) in zip(cols, _by(order), strict=True)]
    counted = running(values, along, keys=["key"], sums={"upto": F.col("n")}, number="nth", unique=True)
    counted = counted.select(F.col("key").alias("v_key"), *[F.col(c).alias(f"v_{c}") for c in cols], (F.col("upto") - F.col("n") + 1).alias("first"), "nth")
    same = F.col("key") == F.col("v_key")
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"v_{c}"))
    return rows.join(counted, same).select("row.*", F.col("first").alias(rank), F.col("nth").alias(dense))


def _written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder: every later read sees the same rows in the same files."""
    path = scratch_path(df.sparkSession, "ordered")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
