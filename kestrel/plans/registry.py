"""Registry of named queries: each is ``fn(spark, sf_dir) -> DataFrame`` plus,
where the result is SQL-expressible, the equivalent DuckDB SQL over the same
tables (views ``orders``, ``lineitem``, ``events``, ...)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` as query ``name`` (and its oracle SQL, if any)."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


SPREAD_CONF = "kestrel.spread.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One of the given parquet tables; column pruning and filters reach the scan.

    A Parquet row group is read by one task, so a file written as a single row
    group gives one busy core however many there are. When the session sets
    ``kestrel.spread.partitions`` to N > 0, scans are dealt round-robin to N tasks
    right after the (pruned, filtered) scan. It is off by default: large inputs
    (many row groups) are already read in parallel and must not pay an extra
    shuffle. ``spread=False`` opts a scan out.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = int(spark.conf.get(SPREAD_CONF, "0") or 0)
    return df.repartition(n) if spread and n > 0 else df
