"""Mergeable approximate aggregates: distinct counts and quantiles as stored sketches.

``build`` reduces rows to one sketch per group (usually per day) with partial aggregation on the
map side; ``store`` and ``load`` keep sketches in a folder partitioned by day; ``merge`` unites
them over any coarser grouping without reading the rows again. Sketch sizes are bounded:
a HyperLogLog sketch has 2^lg_k registers (relative standard error 1.04 / sqrt(2^lg_k)), a KLL sketch
some three times k numbers (rank error about 1.3 % at k = 200).

Nulls count in ``n`` but enter no sketch; a group with nulls only has an empty sketch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K, K = 12, 200


def build(df: DataFrame, by: Sequence[str], distinct: Sequence[str] = (), values: Sequence[str] = (), lg_k: int = LG_K, k: int = K) -> DataFrame:
    """``by``, n, ``<column>_hll`` for each of ``distinct`` and ``<column>_kll`` for each of ``values``."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c), F.lit(lg_k)).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_kll") for c in values],
    )


def merge(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups: counts added, sketches united."""
    aggs = [F.sum("n").alias("n")]
    for c in sketches.columns:
        if c.endswith("_hll"):
            aggs.append(F.hll_union_agg(c).alias(c))
        elif c.endswith("_kll"):
            aggs.append(F.kll_merge_agg_double(c).alias(c))
    return sketches.groupBy(*by).agg(*aggs)


def rolling(sketches: DataFrame, day: str, days: int, by: Sequence[str] = ()) -> DataFrame:
    """For every day with rows, the sketch of the ``days`` days up to it.

    Each daily sketch is sent to the days it counts for: ``days`` small rows, never the events.
    """
    own = sketches.select(F.col(day).alias("_own"), *by).distinct()
    sent = sketches.withColumn("_own", F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))).drop(day)
    return merge(sent.join(own, ["_own", *by]), ["_own", *by]).withColumnRenamed("_own", day)


def estimates(sketches: DataFrame, quantiles: Mapping[str, float] | None = None) -> DataFrame:
    """Sketches replaced by numbers: ``<column>_distinct`` and, for each quantile's name, ``<column>_<name>``."""
    out = []
    for c in sketches.columns:
        if c.endswith("_hll"):
            out.append(F.hll_sketch_estimate(c).alias(f"{c.removesuffix('_hll')}_distinct"))
        elif c.endswith("_kll"):
            some = F.kll_sketch_get_n_double(c) > 0
            out += [F.when(some, F.kll_sketch_get_quantile_double(c, F.lit(q))).alias(f"{c.removesuffix('_kll')}_{name}") for name, q in (quantiles or {}).items()]
        else:
            out.append(F.col(f"`{c}`"))
    return sketches.select(*out)


def store(sketches: DataFrame, path: str, day: str) -> None:
    """Write each day's sketches, replacing only the days that are written (a rerun adds nothing)."""
    sketches.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
