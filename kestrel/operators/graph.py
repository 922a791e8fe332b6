"""Route graph as two DataFrames.

``vertices(id, ...)`` and ``edges(src, dst, n)``: ``n`` counts the input rows per
directed pair (self-loops kept). Vertex ids are the keys themselves (string or
long), so two different airports can never share an id (H13).

Scale notes: every aggregate here is a partial + final hash aggregate, so a
hub vertex holding a third of all rows is pre-aggregated on each map task
before the shuffle. Top-k results use ``orderBy().limit(k)``, which Spark plans as
``TakeOrderedAndProject`` (per-partition top-k, then a merge of k rows per
partition): no global sort. Ties are always broken by the key columns (H11).
Vertex tables are joined only when they carry attributes or come from elsewhere;
adaptive execution broadcasts a small one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import route_text

# The 29 fields of a flight record, in file order.
FLIGHT_FIELDS = (
    "Year", "Month", "DayofMonth", "DayOfWeek", "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "UniqueCarrier", "FlightNum", "TailNum", "ActualElapsedTime", "CRSElapsedTime", "AirTime", "ArrDelay",
    "DepDelay", "Origin", "Dest", "Distance", "TaxiIn", "TaxiOut", "Cancelled", "CancellationCode", "Diverted",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
FLIGHT_SCHEMA = ", ".join(f"{f} string" for f in FLIGHT_FIELDS)


def parse_flights(lines: DataFrame, header_token: str = "Year") -> DataFrame:
    """Comma-separated flight lines (header rows dropped) -> 29 trimmed strings."""
    from ..sources.parsers import parse_delimited

    return parse_delimited(lines, FLIGHT_SCHEMA, sep=",", header_token=header_token)


def vertices(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """G1: distinct endpoints of all rows -> ``(id)``."""
    return df.select(F.explode(F.array(F.col(src), F.col(dst))).alias("id")).distinct()


def edges(df: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Weighted directed edges -> ``(src, dst, n)``."""
    return df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.count(F.lit(1)).alias("n"))


def summary(v: DataFrame, e: DataFrame) -> DataFrame:
    """One row ``(n_vertices, n_edges)`` from one aggregation over a union (no join).

    ``n_edges`` counts distinct routes (the original printed it as "flights").
    """
    tagged = v.select(F.lit(1).alias("_v"), F.lit(0).alias("_e")).unionByName(
        e.select(F.lit(0).alias("_v"), F.lit(1).alias("_e"))
    )
    return tagged.agg(
        F.coalesce(F.sum("_v"), F.lit(0)).cast("long").alias("n_vertices"),
        F.coalesce(F.sum("_e"), F.lit(0)).cast("long").alias("n_edges"),
    )


def _vertex_side(v: DataFrame, end: str) -> DataFrame:
    return v.select(F.col("id").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in v.columns if c != "id"])


def triplets(v: DataFrame, e: DataFrame) -> DataFrame:
    """Edges with the attributes of both end vertices (``src_*``, ``dst_*``).

    Edges whose ends are not vertices drop out, as in a property graph.
    """
    out = e
    for end in ("src", "dst"):
        side = _vertex_side(v, end)
        out = out.join(side, end, "left_semi" if len(side.columns) == 1 else "inner")
    return out


def top_routes(e: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` heaviest routes with their ``"src -> dst: n"`` text."""
    top = e.orderBy(F.desc("n"), F.asc("src"), F.asc("dst")).limit(k)
    return top.select("src", "dst", "n", route_text("src", "dst", "n").alias("route"))


def weighted_out_degree(e: DataFrame) -> DataFrame:
    """A4: total weight leaving each vertex -> ``(src, n)``."""
    return e.groupBy("src").agg(F.sum("n").cast("long").alias("n"))


def busiest(e: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` vertices with the most departures."""
    return weighted_out_degree(e).orderBy(F.desc("n"), F.asc("src")).limit(k)


def in_degrees(e: DataFrame) -> DataFrame:
    """A10: number of distinct routes into each vertex -> ``(id, degree)``."""
    return e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def out_degrees(e: DataFrame) -> DataFrame:
    """A10: number of distinct routes out of each vertex -> ``(id, degree)``."""
    return e.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def _with_vertices(deg: DataFrame, v: DataFrame | None) -> DataFrame:
    # Degree x vertex inner join; vertices without a degree are not listed.
    if v is None:
        return deg
    extra = [c for c in v.columns if c != "id"]
    return deg.join(v, "id", "inner" if extra else "left_semi")


def least_in(v: DataFrame | None, e: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` vertices with the fewest distinct incoming routes.

    ``v=None`` stands for the edges' own end points: no join is needed then.
    """
    return _with_vertices(in_degrees(e), v).orderBy(F.asc("degree"), F.asc("id")).limit(k)


def most_out(v: DataFrame | None, e: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` vertices with the most distinct outgoing routes (``v`` as above)."""
    return _with_vertices(out_degrees(e), v).orderBy(F.desc("degree"), F.asc("id")).limit(k)
