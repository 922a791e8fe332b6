"""Queries for stored sketches and for grouping sets, rollup and cube."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cubes, sketches
from ..session import scratch_path
from .registry import query, table

#: Allowed errors: three standard errors of the distinct count, and of a rank.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sketches of the events, stored in three loads; the second is run twice."""
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "sketches")
    for load in (0, 1, 1, 2):
        rows = events.where(F.least(F.lit(2), F.expr("(day(ts) - 1) div 10")) == load)
        sketches.store(sketches.build(rows, ["day", "event_type"], distinct=["user_id", "event_id"], values=["value"]), path, "day")
    return sketches.load(spark, path)


def _near(estimate: str, exact: str):
    return F.abs(F.col(estimate) - F.col(exact)) <= DISTINCT_ERROR * F.col(exact)


@query("sketch_month_facts", """select event_type, count(*) n, count(distinct user_id) users, count(distinct event_id) events, true users_near, true events_near
from events group by 1""")
def sketch_month_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users and events per type over the month, from daily sketches, against exact counts."""
    found = sketches.estimates(sketches.merge(_stored(spark, sf_dir), ["event_type"]))
    exact = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_id").alias("events"))
    out = found.join(exact, "event_type")
    return out.select("event_type", "n", "users", "events", _near("user_id_distinct", "users").alias("users_near"), _near("event_id_distinct", "events").alias("events_near"))


@query("sketch_rolling_facts", """with d as (select distinct ts::date as day from events)
select d.day as day, count(*) n, count(distinct user_id) users, true users_near from d join events e on e.ts::date between d.day - 6 and d.day group by 1""")
def sketch_rolling_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the last seven days, for each day: seven small sketches united."""
    daily = sketches.merge(_stored(spark, sf_dir), ["day"])
    found = sketches.estimates(sketches.rolling(daily, "day", 7))
    events = table(spark, sf_dir, "events").select("user_id", F.explode(F.sequence(F.to_date("ts"), F.date_add(F.to_date("ts"), 6))).alias("day"))
    exact = events.groupBy("day").agg(F.count_distinct("user_id").alias("users"))
    return found.join(exact, "day").select("day", "n", "users", _near("user_id_distinct", "users").alias("users_near"))


_QUANTILES = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


@query("sketch_quantile_facts", "select event_type, count(*) n, true p50, true p90, true p99 from events group by 1")
def sketch_quantile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the month from daily sketches: their exact ranks are within 3 % of what was asked."""
    found = sketches.estimates(sketches.merge(_stored(spark, sf_dir), ["event_type"]), _QUANTILES)
    rows = table(spark, sf_dir, "events").select("event_type", "value").join(F.broadcast(found.drop("n")), "event_type")  # one row per type
    share = rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg((F.col("value") < F.col(f"value_{q}")).cast("int")).alias(f"{q}_below") for q in _QUANTILES],
        *[F.avg((F.col("value") <= F.col(f"value_{q}")).cast("int")).alias(f"{q}_upto") for q in _QUANTILES],
    )
    return share.select("event_type", "n", *[((F.col(f"{q}_below") <= x + RANK_ERROR) & (F.col(f"{q}_upto") >= x - RANK_ERROR)).alias(q) for q, x in _QUANTILES.items()])


_AGGS = {"n": ("count", "*"), "total": ("sum", "l_quantity"), "top": ("max", "l_extendedprice"), "low": ("min", "l_discount"), "mean": ("avg", "l_quantity")}
_AGG_SQL = "count(*) n, sum(l_quantity) total, max(l_extendedprice) top, min(l_discount) low, avg(l_quantity) mean"
_DIMS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; a quarter without line status, which is no rolled-up status."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_DIMS, "l_quantity", "l_extendedprice", "l_discount")
    return lines.withColumn("l_linestatus", F.when(F.col("l_orderkey") % 4 != 0, F.col("l_linestatus")))


_LINES_SQL = "(select l_returnflag, case when l_orderkey % 4 <> 0 then l_linestatus end l_linestatus, l_linenumber, l_quantity, l_extendedprice, l_discount from lineitem)"


@query("rollup_lineitem", f"select {', '.join(_DIMS)}, grouping({', '.join(_DIMS)})::bigint grouping_id, {_AGG_SQL} from {_LINES_SQL} group by rollup ({', '.join(_DIMS)})")
def rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.rollup(_lines(spark, sf_dir), _DIMS, _AGGS)


@query("cube_lineitem", f"select {', '.join(_DIMS)}, grouping({', '.join(_DIMS)})::bigint grouping_id, {_AGG_SQL} from {_LINES_SQL} group by cube ({', '.join(_DIMS)})")
def cube_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cubes.cube(_lines(spark, sf_dir), _DIMS, _AGGS)


@query("grouping_sets_orders", """select o_orderstatus, o_orderpriority, year(o_orderdate) y, grouping(o_orderstatus, o_orderpriority, year(o_orderdate))::bigint grouping_id,
count(*) n, max(o_totalprice) top, min(o_custkey) low from orders group by grouping sets ((o_orderstatus, y), (o_orderpriority), (o_orderpriority, y), ())""")
def grouping_sets_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate").cast("long"))
    sets = [("o_orderstatus", "y"), ("o_orderpriority",), ("o_orderpriority", "y"), ()]
    return cubes.grouping_sets(orders, ["o_orderstatus", "o_orderpriority", "y"], sets, {"n": ("count", "*"), "top": ("max", "o_totalprice"), "low": ("min", "o_custkey")})
