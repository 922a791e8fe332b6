"""Micro-batch jobs.

Every job is a Structured Streaming query with a checkpoint location (offsets
and commits survive a driver restart: a restarted query resumes and does not
reprocess committed batches, T6) and a ``foreachBatch`` body that writes
idempotently: output is partitioned by ``batch_id`` and written with dynamic
partition overwrite, so a batch that is replayed after a failure replaces its
own output instead of adding to it.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import date_parts, split_whitespace
from ..sources.files import CSV_EXACT

BatchFn = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame,
    foreach_batch: BatchFn,
    checkpoint: str,
    interval: str | None = "2 seconds",
    available_now: bool = False,
    timeout_s: float | None = None,
    name: str | None = None,
    grace_s: float = 30.0,
    output_mode: str | None = None,
) -> StreamingQuery:
    """Run ``foreach_batch`` on each micro-batch.

    ``available_now=True`` processes what is there and stops (tests, backfills);
    otherwise batches fire every ``interval`` and, with ``timeout_s``, the query is
    stopped after that long (the original ran 30 s / 60 s). The stop is graceful:
    a micro-batch in progress may finish first (up to ``grace_s`` more seconds).
    Returns the query.
    """
    writer = stream.writeStream.foreachBatch(foreach_batch).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if output_mode:
        writer = writer.outputMode(output_mode)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    elif timeout_s is not None:
        if not q.awaitTermination(timeout_s):
            _stop_gracefully(q, grace_s)
    if q.exception() is not None:
        raise q.exception()
    return q


def _stop_gracefully(q: StreamingQuery, grace_s: float) -> None:
    """Stop ``q`` between micro-batches: wait (bounded) for the active trigger to end."""
    deadline = time.monotonic() + grace_s
    while q.isActive and q.status.get("isTriggerActive") and time.monotonic() < deadline:
        time.sleep(0.1)
    q.stop()


def _write_batch(df: DataFrame, path: str, partitions: list[str], fmt: str = "parquet", **options) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def parse_tokens(lines: DataFrame, value: str = "value") -> DataFrame:
    """Trim each line, split on whitespace runs -> ``(token, number)``, ``number`` a bigint.

    A blank line gives no row; a token that is no bigint gives a null number, so it can
    be counted (H4).
    """
    toks = lines.select(F.explode(split_whitespace(value)).alias("token")).where("token <> ''")
    return toks.select("token", F.col("token").try_cast("bigint").alias("number"))


def parse_numbers(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """The numbers of each line -> ``(number bigint)``.

    Lenient by default (H4): bad tokens give no row; count them with :func:`parse_tokens`
    (``count_per_batch`` does). ``strict=True`` fails the stream like the original did.
    """
    if strict:
        toks = lines.select(F.explode(split_whitespace(value)).alias("token"))
        return toks.select(F.col("token").cast("bigint").alias("number"))
    return parse_tokens(lines, value).select("number").where(F.col("number").isNotNull())


def count_batch(batch: DataFrame, batch_id: int, value: str = "number") -> DataFrame:
    """Counts per value of one micro-batch only (no state carried over)."""
    return batch.groupBy(value).agg(F.count(F.lit(1)).alias("n")).withColumn("batch_id", F.lit(batch_id).cast("long"))


def count_per_batch(numbers: DataFrame, sink: str, checkpoint: str, value: str = "number",
                    **run_options) -> StreamingQuery:
    """Per-batch value counts written to ``sink`` as ``(value, n, batch_id)``.

    Counts reset at every batch: this is not a running aggregate (a streaming
    ``groupBy`` would keep totals in state). The counts are computed and written
    on the executors; nothing goes to the driver. Fed with :func:`parse_tokens`, a
    batch's row with a null value counts its rejected tokens
    (:func:`rejected_per_batch` reads them).
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        _write_batch(count_batch(batch, batch_id, value), sink, ["batch_id"])

    return run(numbers, body, checkpoint, **run_options)


def rejected_per_batch(counts: DataFrame, value: str = "number") -> DataFrame:
    """``(batch_id, accepted, rejected)`` from the sink of :func:`count_per_batch` over :func:`parse_tokens`."""
    bad = F.col(value).isNull()
    return counts.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.coalesce(F.sum(F.when(~bad, F.col("n"))), F.lit(0)).cast("long").alias("accepted"),
        F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).cast("long").alias("rejected"),
    )


def score(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
          **run_options) -> StreamingQuery:
    """T5: apply a batch-trained model (``scorer(batch) -> DataFrame``) to each micro-batch.

    Use this for models that need joins/aggregates per batch (the exact naive
    Bayes tables); a spark.ml ``PipelineModel`` can also transform the stream
    directly.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        out = scorer(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        _write_batch(out, sink, ["batch_id"])

    return run(stream, body, checkpoint, **run_options)


ETL_PARTITIONS = ["depYear", "depMonth", "depDay"]


def land_batch(batch: DataFrame, batch_id: int, path: str, ts_col: str, columns: list[str], sep: str = "|",
               files_per_day: int | None = None, table: str | None = None, rebalance: bool = True) -> None:
    """K4: write one batch under ``depYear=YYYY/depMonth=MM/depDay=DD/batch_id=N``.

    Dynamic partition overwrite: writing the same ``batch_id`` again replaces
    only that batch's folders, so a replayed batch adds nothing. Rows are first
    rebalanced by day (``rebalance=False``: written as they are dealt): adaptive execution gives each day as many files as its
    size asks for and splits a day that holds most of the batch.
    ``files_per_day=k`` instead shuffles rows by day and a hash of the row into k
    buckets: at most k files per day. The text format is CSV with doubled quotes
    (``CSV_EXACT``): line breaks, quotes, the separator and the text ``null`` all
    come back as they were.

    With ``table`` (a catalog table over ``path``, see
    :func:`kestrel.streaming.catalog.create_partitioned_table`) the batch's new
    partitions are registered right after the write.
    """
    year, month, day = date_parts(ts_col)
    out = batch.select(
        *columns,
        year.alias("depYear"), month.alias("depMonth"), day.alias("depDay"),
        F.lit(batch_id).cast("long").alias("batch_id"),
    )
    dealt = out.hint("rebalance", *ETL_PARTITIONS) if rebalance else out
    if files_per_day:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(int(files_per_day)))
        dealt = out.repartition(*[F.col(c) for c in ETL_PARTITIONS], salt)
    _write_batch(dealt, path, [*ETL_PARTITIONS, "batch_id"], fmt="csv", sep=sep, **CSV_EXACT)
    if table is not None:
        from .catalog import add_partitions

        # The days alone: a second, pruned look at the batch instead of a cached copy of it.
        add_partitions(out.sparkSession, table, out.select(*ETL_PARTITIONS, F.col("batch_id").cast("string")))


def partitioned_etl(
    stream: DataFrame,
    path: str,
    ts_col: str,
    columns: list[str],
    checkpoint: str,
    sep: str = "|",
    on_batch: Callable[[int], None] | None = None,
    files_per_day: int | None = None,
    table: str | None = None,
    **run_options,
) -> StreamingQuery:
    """Land each micro-batch as ``sep``-delimited text, partitioned by day and batch.

    One partitioned write per batch (no driver loop over days). Two batches of
    the same day land in different ``batch_id`` folders; replaying a batch id
    overwrites only its own folders. With ``table`` each batch registers its
    own new partitions in the catalog (no full-folder repair); ``on_batch`` runs
    after each write.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        # a micro-batch of one task writes one file a day at most: nothing to gain by a shuffle
        many = batch.rdd.getNumPartitions() > 1
        land_batch(batch, batch_id, path, ts_col, columns, sep, files_per_day, table, rebalance=many)
        if on_batch is not None:
            on_batch(batch_id)

    return run(stream, body, checkpoint, **run_options)


def read_partitioned(spark, path: str, columns: list[tuple[str, str]], sep: str = "|",
                     partitions: list[str] | None = None) -> DataFrame:
    """Read the ETL output back; partition columns stay strings (``01`` stays ``01``, H9)."""
    parts = partitions or [*ETL_PARTITIONS, "batch_id"]
    ddl = ", ".join([f"`{n}` {t}" for n, t in columns] + [f"`{p}` string" for p in parts])
    return spark.read.schema(ddl).options(sep=sep, **CSV_EXACT).csv(path)
