"""Queries for the DataFrame job (J1, J2, A1, A12, O1) on ``orders`` / ``lineitem``.

Mapping to the original job: ``orders`` plays the list of all films
(``yearOfMovie`` = order year, ``movie`` = order key) and all line items play the
rated films (``year`` = ship year, ``title`` = order key, ``IMDB`` = quantity). The join keys stay native (int/bigint) so hashing and
comparison are cheap; they are printed as strings only in the final projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as rel
from .registry import query, table


def _films(spark: SparkSession, sf_dir: str) -> DataFrame:
    # not dealt out after the scan: the joins shuffle by their keys anyway
    return table(spark, sf_dir, "orders", spread=False).select(F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("m"))


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem", spread=False)
        .select(F.year("l_shipdate").alias("ry"), F.col("l_orderkey").alias("rm"), F.col("l_quantity").alias("q"))
    )


_ENRICH_CTE = """
with l as (select year(o_orderdate) y, o_orderkey m from orders),
r as (select year(l_shipdate) ry, l_orderkey rm, l_quantity q from lineitem),
j as (select l.y, l.m, r.q from l left join r on l.y = r.ry and l.m = r.rm)
"""


@query("left_outer_enrich", _ENRICH_CTE + "select cast(y as varchar) y, cast(m as varchar) m, q from j")
def left_outer_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = rel.enrich(_films(spark, sf_dir), _rated(spark, sf_dir), on=[("y", "ry"), ("m", "rm")])
    return joined.select(F.col("y").cast("string").alias("y"), F.col("m").cast("string").alias("m"), "q")


@query(
    "left_outer_enrich_split",
    "select l.o_orderkey k, cast(year(l.o_orderdate) as integer) y, l.o_totalprice as amount, r.l_extendedprice as paid, r.l_linenumber line "
    "from orders l left join lineitem r on l.o_orderkey = r.l_orderkey and year(l.o_orderdate) = year(r.l_shipdate)",
)
def left_outer_enrich_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 in its skew-safe form; both sides have a column ``amount``."""
    left = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("amount")
    )
    right = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rk"), F.year("l_shipdate").alias("ry"), F.col("l_extendedprice").alias("amount"), F.col("l_linenumber").alias("line")
    )
    joined = rel.enrich(left, right, on=[("k", "rk"), ("y", "ry")], skew_safe=True)
    return joined.toDF("k", "y", "amount", "paid", "line")


@query("enrich_count", _ENRICH_CTE + "select count(*) n from j")
def enrich_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of rows of the enriched table (the original counted them to size its preview)."""
    joined = rel.enrich(_films(spark, sf_dir), _rated(spark, sf_dir), on=[("y", "ry"), ("m", "rm")])
    return joined.agg(F.count(F.lit(1)).alias("n"))


@query("group_count", "select cast(year(o_orderdate) as varchar) y, count(*) n from orders group by 1")
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rel.group_count(_films(spark, sf_dir), "y", "n")
    return counts.select(F.col("y").cast("string").alias("y"), "n")


def enrich_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: left outer enrich, per-year counts attached, sorted by (year, value)."""
    films = _films(spark, sf_dir)
    joined = rel.enrich(films, _rated(spark, sf_dir), on=[("y", "ry"), ("m", "rm")])
    counts = rel.group_count(films, "y", "n")
    out = rel.with_group_count(joined, counts, "y")
    # (y, q) has a few hundred values at any size; the order key as last sort key lets the
    # range partitioner split a hot (y, q) pair over many tasks.
    out = rel.sort(out, "y", "q", "m")
    return out.select(F.col("y").cast("string").alias("y"), F.col("m").cast("string").alias("m"), "q", "n")


query(
    "enrich_with_counts",
    _ENRICH_CTE
    + """, c as (select y, count(*) n from l group by y)
select cast(j.y as varchar) y, cast(j.m as varchar) m, j.q, c.n from j join c on j.y = c.y""",
)(enrich_with_counts)


@query(
    "group_max_string",
    "select cast(year(o_orderdate) as varchar) y, max(cast(o_custkey as varchar)) v from orders group by 1",
)
def group_max_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("y"), F.col("o_custkey").cast("string").alias("c")
    )
    return rel.group_max(orders, "y", "c", name="v")


@query(
    "group_max_numeric",
    "select cast(year(o_orderdate) as varchar) y, max(o_totalprice) v from orders group by 1",
)
def group_max_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 with ``cast`` (H5): values held as strings (as a header-only CSV read gives
    them) compared as numbers instead of text."""
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("y"), F.col("o_totalprice").cast("string").alias("p")
    )
    return rel.group_max(orders, "y", "p", cast="double", name="v")
