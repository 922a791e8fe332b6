"""Route-graph queries on ``events``: ``user_id -> props.k`` plays origin -> destination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph as g
from .registry import query, table

_E = """
with f as (select user_id src, cast(json_extract_string(props, '$.k') as bigint) dst from events),
e as (select src, dst, count(*) n from f group by 1, 2)
"""


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip: ``(src, dst)``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("src"), F.get_json_object("props", "$.k").cast("long").alias("dst"))


def _graph(spark: SparkSession, sf_dir: str):
    # Vertices from the aggregated edges (same endpoints, far fewer rows than the trips).
    e = g.edges(routes(spark, sf_dir))
    return g.vertices(e), e


@query("graph_vertices", _E + "select src id from f union select dst from f")
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.vertices(routes(spark, sf_dir))


@query("graph_summary", _E + """select (select count(*) from (select src from f union select dst from f)) n_vertices,
(select count(*) from e) n_edges""")
def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = _graph(spark, sf_dir)
    return g.summary(v, e)


@query("graph_top_routes", _E + """select src, dst, n, concat(src, ' -> ', dst, ': ', n) route
from e order by n desc, src, dst limit 10""")
def graph_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.top_routes(g.edges(routes(spark, sf_dir)), 10)


@query("graph_out_weight", _E + "select src, cast(sum(n) as bigint) n from e group by 1")
def graph_out_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.weighted_out_degree(g.edges(routes(spark, sf_dir)))


@query("graph_busiest", _E + "select src, cast(sum(n) as bigint) n from e group by 1 order by 2 desc, 1 limit 1")
def graph_busiest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.busiest(g.edges(routes(spark, sf_dir)), 1)


@query("graph_in_degrees", _E + "select dst id, count(*) degree from e group by 1")
def graph_in_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.in_degrees(g.edges(routes(spark, sf_dir)))


@query("graph_least_in", _E + "select dst id, count(*) degree from e group by 1 order by 2, 1 limit 10")
def graph_least_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.least_in(None, g.edges(routes(spark, sf_dir)), 10)


@query("graph_most_out", _E + "select src id, count(*) degree from e group by 1 order by 2 desc, 1 limit 10")
def graph_most_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.most_out(None, g.edges(routes(spark, sf_dir)), 10)


@query("graph_triplets", _E + "select src, dst, n from e")
def graph_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = _graph(spark, sf_dir)
    return g.triplets(v, e)


# Vertices with attributes from another table (customers): only some end points are known.
_V = _E + ", v as (select c_custkey id, c_name as name, c_nationkey nation from customer)\n"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))


@query("graph_triplets_named", _V + """select src, dst, n, s.name src_name, s.nation src_nation, d.name dst_name,
d.nation dst_nation from e join v s on e.src = s.id join v d on e.dst = d.id""")
def graph_triplets_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between customers, with both customers' names and nations."""
    return g.triplets(_customers(spark, sf_dir), g.edges(routes(spark, sf_dir)))


@query("graph_least_in_named", _V + """select id, degree, name, nation from (select dst id, count(*) degree from e group by 1)
join v using (id) order by degree, id limit 10""")
def graph_least_in_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least reached customers, with their attributes."""
    return g.least_in(_customers(spark, sf_dir), g.edges(routes(spark, sf_dir)), 10)


@query("graph_most_out_named", _V + """select id, degree, name, nation from (select src id, count(*) degree from e group by 1)
join v using (id) order by degree desc, id limit 10""")
def graph_most_out_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.most_out(_customers(spark, sf_dir), g.edges(routes(spark, sf_dir)), 10)
