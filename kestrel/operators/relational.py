"""Relational operators of the DataFrame job.

Scale notes
-----------
* Nothing is counted, sampled or cached while a plan is built: adaptive execution picks the
  join from the sizes it has really shuffled (a small side is broadcast at run time), so a
  plan sees the data as it is when it runs.
* ``enrich`` joins two large tables (sort-merge join, both sides shuffled on the key). A hot
  key on the left, or on either side of an inner join, is split by adaptive execution; a hot
  right key of a left outer join is split when ``skew_safe=True`` asks for that form.
* ``with_group_count`` attaches per-key counts to every row. The keys can be few (years); the
  counts are then small and adaptive execution reads the big side in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left_outer",
    keep_right_keys: bool = False,
    skew_safe: bool = False,
) -> DataFrame:
    """Equi-join on a composite key (default left outer).

    Unmatched left rows keep null right columns; duplicate right keys fan out;
    null keys never match. The result has the left columns, then the right ones (its key
    columns only if asked for), by position: a name that both sides use appears twice.

    Adaptive execution splits a hot key on either side of an inner join but only on the
    left side of a left outer join. ``skew_safe=True`` computes the left outer join as
    ``inner join UNION ALL (left anti-join distinct right keys)``: the same rows and columns,
    safe for a hot right key, at the price of reading the left side twice.
    """

    def matches(r: DataFrame) -> Column:
        cond: Column | None = None
        for lk, rk in on:
            term = left[lk] == r[rk]
            cond = term if cond is None else (cond & term)
        return cond

    right_keys = [rk for _, rk in on]
    payload = [f for f in right.schema.fields if keep_right_keys or f.name not in right_keys]

    def both(joined: DataFrame) -> DataFrame:
        return joined.select(*[left[c] for c in left.columns], *[right[f.name] for f in payload])

    if not (skew_safe and how in ("left_outer", "left", "leftouter")):
        return both(left.join(right, matches(right), how))
    keys = right.select(*right_keys).distinct()
    unmatched = left.join(keys, matches(keys), "left_anti")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in payload]
    return both(left.join(right, matches(right), "inner")).union(unmatched.select(*left.columns, *nothing))


def group_count(df: DataFrame, key: str | Sequence[str], name: str = "count") -> DataFrame:
    """A1: rows per key (partial + final hash aggregate), the count renamed."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_count(
    df: DataFrame,
    counts: DataFrame,
    key: str,
    counts_key: str | None = None,
) -> DataFrame:
    """Attach the per-key count to every row (inner join: null keys drop out).

    This is deliberately a join and not a window count: rows whose key is null
    disappear, as in the original job.
    """
    counts_key = counts_key or key
    if counts_key != key:
        counts = counts.withColumnRenamed(counts_key, key)
    return df.join(counts, key, "inner")


def group_max(df: DataFrame, key: str, value: str, cast: str | None = None, name: str | None = None) -> DataFrame:
    """Maximum per key. Without ``cast`` strings compare lexicographically (H5)."""
    v = F.col(value).cast(cast) if cast else F.col(value)
    return df.groupBy(key).agg(F.max(v).alias(name or f"max_{value}"))


def sort(df: DataFrame, *cols: str) -> DataFrame:
    """O1: ascending multi-column sort, nulls first (Spark's default for ascending)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])
