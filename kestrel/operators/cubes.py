"""Grouping sets, rollup and cube from the finest partial result.

Spark's own forms copy every input row once per grouping set before they aggregate. Here rows are
aggregated to the finest groups first (with partial aggregation on the map side, so hot groups
shrink before the shuffle), and only those groups are copied and merged. That needs aggregates
that merge: count, sum, min, max, avg (as sum and count).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of an aggregate, and the column it is taken of ("*" counts rows).
Aggregate = tuple[str, str]


def _partial(kind: str, col: str, name: str) -> list[Column]:
    value = F.lit(1) if col == "*" else F.col(f"`{col}`")
    if kind == "avg":
        return [F.sum(value.cast("double")).alias(f"_{name}"), F.count(value).alias(f"_{name}_n")]
    if kind not in ("count", "sum", "min", "max"):
        raise ValueError(f"{kind} does not merge; use count, sum, min, max or avg")
    return [getattr(F, kind)(value).alias(f"_{name}")]


def _merged(kind: str, name: str) -> Column:
    if kind == "avg":
        return (F.sum(f"_{name}") / F.nullif(F.sum(f"_{name}_n"), F.lit(0))).alias(name)
    if kind == "count":
        return F.coalesce(F.sum(f"_{name}"), F.lit(0)).alias(name)
    return getattr(F, kind)(f"_{name}").alias(name)


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]], aggs: Mapping[str, Aggregate], grouping_id: str = "grouping_id") -> DataFrame:
    """``dims`` (null where a set leaves one out), ``grouping_id`` and ``aggs`` for each set.

    Bit i of the id (the first dimension has the highest) is 1 where the dimension is left
    out, which tells it from a null of the data. Sets given twice come twice.
    """
    unknown = {c for s in sets for c in s} - set(dims)
    if unknown:
        raise ValueError(f"not among the dimensions: {sorted(unknown)}")
    fine = df.groupBy(*dims).agg(*[c for name, (kind, col) in aggs.items() for c in _partial(kind, col, name)])
    chosen = [[F.col(f"`{c}`") for c in dims if c in s] for s in sets]
    out = fine.groupingSets(chosen, *[F.col(f"`{c}`") for c in dims]).agg(F.grouping_id().alias(grouping_id), *[_merged(kind, name) for name, (kind, _) in aggs.items()])
    return out.select(*dims, grouping_id, *aggs)


def rollup(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Aggregate], grouping_id: str = "grouping_id") -> DataFrame:
    """All prefixes of ``dims``, the empty one included."""
    return grouping_sets(df, dims, [dims[:n] for n in range(len(dims), -1, -1)], aggs, grouping_id)


def cube(df: DataFrame, dims: Sequence[str], aggs: Mapping[str, Aggregate], grouping_id: str = "grouping_id") -> DataFrame:
    """All subsets of ``dims``."""
    return grouping_sets(df, dims, [s for n in range(len(dims), -1, -1) for s in combinations(dims, n)], aggs, grouping_id)
