"""Stateful stream jobs: event-time windows, running state per key, dedup, interval joins.

Spark's state store holds the state and its watermark closes it. Rows that come too late for
their state are dropped by Spark without a trace; these jobs write them to a side output instead,
so that every input row is either in a result or counted.

How the side output is exact: the query's output is the union of the stateful result and the
batch's own input rows. Spark's watermark of a batch is the largest event time of the batches
before it, less the delay (the smallest such value, where two inputs have one each). The job
keeps the same number in a clock: each batch observes its largest event time while it is
written and stores it beside its output; the next batch reads one clock row per input. Output
and clock are written per ``batch_id`` with overwrite, so a replayed batch reads the same clock
and replaces its own rows.

Layout of ``out``: ``rows/kind=<result | late | no_time>/batch_id=<n>`` and ``clock/batch_id=<n>``;
:func:`results` and :func:`late_rows` read them. Rows without event time are ``no_time`` rows.

``state_partitions`` (an option of all jobs; default: the session's shuffle partitions) is the number of
state stores per operator. It is fixed by a job's first run. Each store costs some files per
batch, so small streams want few, large ones as many as the cluster has cores.

Scale: windows, sessions and dedup shuffle by their keys after Spark's partial aggregation
(sessions merge within map partitions first, see :func:`sessions`); running counts are
pre-aggregated per Arrow batch, so a hot key sends few rows, and held by buckets of keys; an interval join is keyed by
(key, time bucket), so a hot key spreads over its buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, DataType, DecimalType, FractionalType, TimestampType

from .jobs import run


@dataclass(frozen=True)
class _Side:
    """One input of a job: its rows, their event time, the delay, and how many of a row's states
    are closed at a watermark (in microseconds)."""

    rows: DataFrame
    time: str
    delay: timedelta
    missed: Callable[[Column, Column], Column]


def _millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


def _micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _text(span: timedelta) -> str:
    return f"{_millis(span)} milliseconds"


def _run(result: DataFrame, sides: Mapping[str, _Side], out: str, checkpoint: str, mode: str, state_partitions: int | None = None, **run_options) -> StreamingQuery:
    union = result.select(F.struct("*").alias("result"))
    for name, side in sides.items():
        union = union.unionByName(side.rows.select(F.struct("*").alias(name)), allowMissingColumns=True)

    # one empty file, so that a job without any row to show has a schema
    none = union.sparkSession.createDataFrame([], union.schema).withColumn("missed", F.lit(0))
    none.write.mode("overwrite").parquet(f"{out}/rows/kind=none/batch_id=0")

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _read_clock(spark, out, batch_id)
        closed = F.lit(before.get("", 0)).cast("long") * 1000
        kind, missed = F.when(F.col("result").isNotNull(), "result"), F.lit(0)
        for name, side in sides.items():
            at = F.col(name)[side.time]
            n = F.when(F.col(name).isNotNull() & at.isNotNull(), side.missed(F.unix_micros(at), closed)).otherwise(0)
            kind = kind.when(F.col(name).isNotNull() & at.isNull(), "no_time").when(n > 0, "late")
            missed = missed + n
        seen = Observation()
        tops = [F.max(F.unix_millis(F.col(n)[s.time])).alias(n) for n, s in sides.items()]
        marked = batch.observe(seen, *tops).select("*", kind.alias("kind"), missed.cast("int").alias("missed"), F.lit(batch_id).cast("long").alias("batch_id"))
        marked.where("kind IS NOT NULL").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch_id").parquet(f"{out}/rows")
        _write_clock(spark, out, batch_id, before, seen.get, sides)

    # a query takes the setting when it starts; its checkpoint keeps it from then on
    conf, name = union.sparkSession.conf, "spark.sql.shuffle.partitions"
    before_run = conf.get(name)
    try:
        conf.set(name, str(state_partitions or before_run))
        return run(union, body, checkpoint, output_mode=mode, **run_options)
    finally:
        conf.set(name, before_run)


def _read_clock(spark: SparkSession, out: str, batch_id: int) -> dict[str, int]:
    """Largest event time of each input so far, and under "" the watermark, in milliseconds."""
    if batch_id == 0:
        return {}
    return {r["name"]: r["ms"] for r in spark.read.parquet(f"{out}/clock/batch_id={batch_id - 1}").collect()}


def _write_clock(spark: SparkSession, out: str, batch_id: int, before: dict[str, int], seen: dict, sides: Mapping[str, _Side]) -> None:
    tops = {n: max(x for x in (before.get(n), seen[n]) if x is not None) for n in sides if before.get(n) is not None or seen[n] is not None}
    marks = [top - _millis(sides[n].delay) for n, top in tops.items()]
    clock = {**tops, "": max([before.get("", 0), min(marks)] if marks else [before.get("", 0)])}
    spark.createDataFrame(list(clock.items()), "name string, ms long").coalesce(1).write.mode("overwrite").parquet(f"{out}/clock/batch_id={batch_id}")


def _rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/rows")


def results(spark: SparkSession, out: str) -> DataFrame:
    """A job's results, with the ``batch_id`` that emitted each."""
    return _rows(spark, out).where("kind = 'result'").select("result.*", F.col("batch_id").cast("long").alias("batch_id"))


def late_rows(spark: SparkSession, out: str, side: str = "row") -> DataFrame:
    """Input rows that missed a state: their columns, ``kind`` (late or no_time), ``missed``, ``batch_id``."""
    rows = _rows(spark, out).where(F.col("kind").isin("late", "no_time") & F.col(side).isNotNull())
    return rows.select(f"{side}.*", "kind", "missed", F.col("batch_id").cast("long").alias("batch_id"))


def windows(stream: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], size: timedelta, out: str, checkpoint: str,
            slide: timedelta | None = None, delay: timedelta = timedelta(0), **run_options) -> StreamingQuery:
    """Tumbling (or, with ``slide``, sliding) event-time windows per key.

    A window ``[start, end)``, aligned to the epoch, is emitted once, when the watermark reaches
    its end: keys, window_start, window_end and ``aggs``. A row whose windows are all open counts
    in all of them; ``missed`` tells how many were closed before it came.
    """
    step = slide or size
    window = F.window(F.col(ts), _text(size), _text(step))
    result = stream.withWatermark(ts, _text(delay)).groupBy(window.alias("w"), *keys).agg(*aggs)
    names = [c for c in result.columns if c != "w"]
    result = result.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in names if c not in keys])

    def missed(at: Column, closed: Column) -> Column:
        first = at - F.pmod(at, F.lit(_micros(step)))  # start of the last window that has the row
        n = F.lit(0)
        for k in range(-(-_micros(size) // _micros(step))):
            end = first + (_micros(size) - k * _micros(step))
            n = n + ((end > at) & (end <= closed)).cast("int")
        return n

    return _run(result, {"row": _Side(stream, ts, delay, missed)}, out, checkpoint, "append", **run_options)


#: Lets the map side merge a key's sessions before the shuffle, so that a hot key sends few rows.
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def sessions(stream: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], gap: timedelta, out: str, checkpoint: str,
             delay: timedelta = timedelta(0), **run_options) -> StreamingQuery:
    """Session windows per key: rows less than ``gap`` apart are one session, which ends ``gap`` after its last row.

    Emitted once, when the watermark reaches the end. The session should set :data:`MERGE_SESSIONS`
    (:func:`kestrel.session.cluster_settings` does).
    """
    result = stream.where(F.col(ts).isNotNull()).withWatermark(ts, _text(delay)).groupBy(F.session_window(F.col(ts), _text(gap)).alias("w"), *keys).agg(*aggs)
    names = [c for c in result.columns if c != "w" and c not in keys]
    result = result.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *names)
    side = _Side(stream, ts, delay, lambda at, closed: (at + _micros(gap) <= closed).cast("int"))
    return _run(result, {"row": side}, out, checkpoint, "append", **run_options)


def distinct(stream: DataFrame, ts: str, keys: Sequence[str], out: str, checkpoint: str, delay: timedelta = timedelta(0), **run_options) -> StreamingQuery:
    """The first row of each key; replays of a row carry the same key and event time.

    A key is remembered until the watermark passes its event time by ``delay``; a replay after that is
    older than the watermark, hence late. So each key counts once and the state stays bounded.
    """
    result = stream.where(F.col(ts).isNotNull()).withWatermark(ts, _text(delay)).dropDuplicatesWithinWatermark(list(keys))
    side = _Side(stream, ts, delay, lambda at, closed: (at <= closed).cast("int"))
    return _run(result, {"row": side}, out, checkpoint, "append", **run_options)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, lower: timedelta, upper: timedelta,
                  out: str, checkpoint: str, how: str = "inner", delay: timedelta = timedelta(0), **run_options) -> StreamingQuery:
    """Pairs with equal ``on`` and ``left_ts + lower <= right_ts <= left_ts + upper``; ``how`` is inner or left_outer.

    The inputs must not share column names but ``on``. Both sides are buffered until the watermark
    passes the time at which a partner could still come; a left row without partner is emitted then
    (``left_outer``). The join key has a time bucket as long as the interval: a left row lies in one
    bucket, a right row is sent to the one or two buckets where its partners can be.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("how must be inner or left_outer")
    length = max(_micros(upper) - _micros(lower), 1_000_000)
    at, to = F.unix_micros(left_ts), F.unix_micros(right_ts)
    lefts = left.where(F.col(left_ts).isNotNull()).withWatermark(left_ts, _text(delay))
    lefts = lefts.withColumn("_bucket", F.floor(at / F.lit(length)).cast("long"))
    low, high = (F.floor((to - _micros(x)) / F.lit(length)).cast("long") for x in (upper, lower))
    rights = right.where(F.col(right_ts).isNotNull()).withWatermark(right_ts, _text(delay))
    rights = rights.withColumn("_bucket", F.explode(F.sequence(low, high)))
    shared = [*on, "_bucket"]
    rights = rights.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(shared)], *[c for c in right.columns if c not in on])
    cond = (F.col(right_ts) >= F.col(left_ts) + lower) & (F.col(right_ts) <= F.col(left_ts) + upper)
    for i, c in enumerate(shared):
        cond = cond & (F.col(c) == F.col(f"_r{i}"))
    result = lefts.join(rights, cond, how).select(*left.columns, *[c for c in right.columns if c not in on])
    sides = {n: _Side(df, ts, delay, lambda at, closed: (at <= closed).cast("int")) for n, df, ts in (("left", left, left_ts), ("right", right, right_ts))}
    return _run(result, sides, out, checkpoint, "append", **run_options)


#: Groups of keys that :func:`running_counts` keeps its state by.
KEY_BUCKETS = 4096


def _key_text(key: str, dtype: DataType) -> tuple[Column, Callable[[Column], Column]]:
    """A key as text, equal for equal keys only, and the way back."""
    col = F.col(f"`{key}`")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col).cast("string"), lambda x: F.timestamp_micros(x.cast("long"))
    if isinstance(dtype, BinaryType):
        return F.base64(col), lambda x: F.unbase64(x)
    plain = col + F.lit(0).cast(dtype) if isinstance(dtype, FractionalType) and not isinstance(dtype, DecimalType) else col  # -0.0 is 0.0
    return plain.cast("string"), lambda x: x.cast(dtype)


def running_counts(stream: DataFrame, ts: str, key: str, timeout: timedelta, out: str, checkpoint: str,
                   resolution: timedelta = timedelta(minutes=1), delay: timedelta = timedelta(0), buckets: int = KEY_BUCKETS, **run_options) -> StreamingQuery:
    """Running counts per key, kept over batches; a key idle for ``timeout`` is closed and starts anew.

    Event times count as the end of their ``resolution`` (a bucket of time), which makes lateness and
    timeouts independent of how rows are dealt to tasks. A batch emits ``(key, n, last, closed)`` with
    ``closed = false`` for each key it has rows of; a timeout emits the final count with
    ``closed = true`` and forgets the key.

    The state has a row per hash bucket of keys, not per key: a call of the state operator costs about
    as much as counting a thousand rows, and a batch makes at most ``buckets`` of them however many keys
    it has. A bucket's timer is that of its first key to close. ``buckets`` is fixed by a job's first run; more of
    them for more than some ten thousand keys each.
    """
    import pyarrow as pa

    text, back = _key_text(key, stream.schema[key].dataType)
    step = _micros(resolution)
    tick = F.timestamp_micros(F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(step)) + step)
    ticks = stream.where(F.col(ts).isNotNull()).select(text.alias("key"), tick.alias("at"), F.lit(1).cast("long").alias("n"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pa.Table.from_batches([batch]).group_by(["key", "at"]).aggregate([("n", "sum")])
            yield from whole.select(["key", "at", "n_sum"]).rename_columns(["key", "at", "n"]).to_batches()

    combined = ticks.mapInArrow(combine, "key string, at timestamp, n long").withWatermark("at", _text(delay))
    bucket = F.when(F.col("key").isNull(), -1).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    bucketed = combined.select(bucket.alias("bucket"), "key", "at", F.unix_millis("at").alias("ms"), "n").groupBy("bucket")
    counted = bucketed.applyInPandasWithState(_counter(_millis(timeout)), "key string, n long, ms long, closed boolean",
                                              "keys array<string>, counts array<long>, lasts array<long>", "update", "EventTimeTimeout")
    result = counted.select(back(F.col("key")).alias(key), "n", F.timestamp_millis("ms").alias("last"), "closed")
    rows = stream.select("*", tick.alias("_tick"))
    side = _Side(rows, "_tick", delay, lambda at, closed: (at <= closed).cast("int"))
    return _run(result, {"row": side}, out, checkpoint, "update", **run_options)


def _counter(timeout_ms: int):
    import warnings

    import pandas as pd

    def step(bucket, parts, state):
        warnings.simplefilter("ignore", FutureWarning)  # Spark's own concatenation of empty frames
        counts = {k: (n, last) for k, n, last in zip(*state.get, strict=True)} if state.exists else {}
        out = []
        if counts:  # idle for too long, whether rows came now or not
            now = state.getCurrentWatermarkMs()
            out = [(k, n, last, True) for k, (n, last) in counts.items() if last + timeout_ms < now]
            for k, *_ in out:
                del counts[k]
        seen = set()
        for part in () if state.hasTimedOut else parts:
            keys = part["key"].tolist() if bucket[0] >= 0 else [None] * len(part)
            for k, n, ms in zip(keys, part["n"].tolist(), part["ms"].tolist(), strict=True):
                before, last = counts.get(k, (0, ms))
                counts[k] = before + n, max(last, ms)
                seen.add(k)
        out += [(k, *counts[k], False) for k in seen]
        if counts:
            state.update((list(counts), [n for n, _ in counts.values()], [last for _, last in counts.values()]))
            state.setTimeoutTimestamp(min(last for _, last in counts.values()) + timeout_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["key", "n", "ms", "closed"])

    return step
