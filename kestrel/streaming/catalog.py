"""Partitioned delimited tables in Spark's own catalog (K5, K6); no Hive needed."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import CSV_EXACT

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_.]*$")


def _check(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"bad identifier {name!r}")
    return name


def create_partitioned_table(
    spark: SparkSession,
    table: str,
    path: str,
    columns: list[tuple[str, str]],
    partitions: list[str],
    sep: str = "|",
) -> None:
    """K5: ``CREATE TABLE IF NOT EXISTS`` over ``path``: delimited text, string partition columns."""
    cols = ", ".join(f"`{_check(n)}` {t}" for n, t in columns)
    parts = ", ".join(f"`{_check(p)}` STRING" for p in partitions)
    exact = ", ".join(f"{k} '{v}'" for k, v in CSV_EXACT.items())
    sep_sql = sep.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_check(table)} ({cols}, {parts}) USING csv "
        f"OPTIONS (sep '{sep_sql}', {exact}) PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)}) "
        f"LOCATION '{path}'"
    )


def repair(spark: SparkSession, table: str) -> None:
    """K6: register every partition directory found under the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {_check(table)}")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """K6: ``SHOW PARTITIONS`` as a DataFrame ``(partition, <one column per key>)``."""
    shown = spark.sql(f"SHOW PARTITIONS {_check(table)}")
    first = shown.select(F.col("partition")).limit(1).collect()
    if not first:
        return shown
    keys = [kv.split("=", 1)[0] for kv in first[0]["partition"].split("/")]
    parts = F.split("partition", "/")
    return shown.select(
        "partition",
        *[F.regexp_extract(F.get(parts, i), "=(.*)$", 1).alias(k) for i, k in enumerate(keys)],
    )


def add_partitions(spark: SparkSession, table: str, parts: DataFrame, per_statement: int = 1_000) -> int:
    """K6, incremental: register the partitions listed in ``parts`` (one column per
    partition key, in table order) with ``ALTER TABLE ... ADD IF NOT EXISTS``.

    Meant for the partitions of one micro-batch (a few days); the distinct values
    are streamed to the driver and sent in statements of ``per_statement``
    partitions, however many there are. Unlike ``MSCK REPAIR`` it never lists the
    whole table folder. Returns the number of partitions named.
    """
    keys = [_check(k) for k in parts.columns]

    def lit(v) -> str:
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    def send(specs: list[str]) -> None:
        if specs:
            spark.sql(f"ALTER TABLE {_check(table)} ADD IF NOT EXISTS {' '.join(specs)}")

    named, specs = 0, []
    for r in parts.distinct().toLocalIterator():
        specs.append("PARTITION (" + ", ".join(f"`{k}` = {lit(r[k])}" for k in keys) + ")")
        named += 1
        if len(specs) == per_statement:
            send(specs)
            specs = []
    send(specs)
    return named
