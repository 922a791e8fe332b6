"""Queries for joins and windows along an order: as-of, interval overlap, running sums, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ordered
from .registry import query, table

_HOUR = 3_600_000_000


@query("asof_last_price", """with p as (select user_id, ts, max(value) price from events where event_type = 'purchase' group by 1, 2)
select e.event_id, e.user_id, p.price from (select * from events where event_type <> 'purchase') e
asof left join p on e.user_id = p.user_id and e.ts >= p.ts""")
def asof_last_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5-like as-of join: every other event with the price of its user's last purchase."""
    events = table(spark, sf_dir, "events")
    prices = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("price"))
    others = events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    out = ordered.asof_join(others, prices, ["user_id"], "ts", "ts", ["price"], bucket=24 * _HOUR)
    return out.select("event_id", "user_id", "price")


@query("asof_previous_order", """select o.o_orderkey, p.previous, p.paid from orders o left join lateral (
  select q.o_orderkey previous, q.o_totalprice paid from orders q where q.o_custkey = o.o_custkey and q.o_orderdate < o.o_orderdate
  and q.o_orderdate >= o.o_orderdate - interval 400 day order by q.o_orderdate desc, q.o_orderkey desc limit 1) p on true""")
def asof_previous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its customer's last order of an earlier day, at most 400 days before."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    past = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("previous"), F.col("o_totalprice").alias("paid"))
    out = ordered.asof_join(orders, past, ["o_custkey"], "o_orderdate", "o_orderdate", ["previous", "paid"], bucket=365 * ordered.DAY,
                            strict=True, tolerance=400 * ordered.DAY)
    return out.select("o_orderkey", "previous", "paid")


@query("asof_last_by_type", """with p as (select event_type, ts, max(value) v from events where event_id % 3 = 0 group by 1, 2)
select e.event_id, p.v from (select * from events where event_id % 3 <> 0) e asof left join p on e.event_type = p.event_type and e.ts >= p.ts""")
def asof_last_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys, each a hot one: hourly buckets make them some 700 tasks a month each."""
    events = table(spark, sf_dir, "events")
    known = events.where("event_id % 3 = 0").select("event_type", "ts", F.col("value").alias("v"))
    others = events.where("event_id % 3 <> 0").select("event_id", "event_type", "ts")
    return ordered.asof_join(others, known, ["event_type"], "ts", "ts", ["v"], bucket=_HOUR).select("event_id", "v")


@query("overlap_orders", """with o as (select o_orderkey k, o_custkey c, o_orderdate a, o_orderdate + to_days((o_orderkey * 7 % 300)::int) b from orders)
select x.k as k, y.k as other from o x join o y on x.c = y.c and x.k < y.k and x.a < y.b and y.a < x.b where x.a < x.b and y.a < y.b""")
def overlap_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one customer that were open at the same time; they stay open for 0 to 299 days."""
    orders = table(spark, sf_dir, "orders")
    end = F.expr("timestampadd(DAY, int(o_orderkey * 7 % 300), o_orderdate)")
    spans = orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderdate").alias("a"), end.alias("b"))
    other = spans.toDF("other", "c2", "a2", "b2")
    pairs = ordered.overlap_join(spans, other, ("a", "b"), ("a2", "b2"), smallest=7 * ordered.DAY, on=[("c", "c2")])
    return pairs.where("k < other").select("k", "other")


@query("range_join_events", """select s.event_id signup, count(*) n, max(c.value) top from events s join events c
on c.event_type = 'click' and c.ts >= s.ts and c.ts < s.ts + interval 20 minute + to_seconds((s.event_id % 5000)::int) where s.event_type = 'signup' group by 1""")
def range_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without any equal key: clicks by anyone in the 20 to 100 minutes after a signup."""
    events = table(spark, sf_dir, "events")
    signups = events.where("event_type = 'signup'").select(F.col("event_id").alias("signup"), F.col("ts").alias("a"),
                                                          F.expr("timestampadd(SECOND, int(1200 + event_id % 5000), ts)").alias("b"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    clicks = events.where("event_type = 'click'").select("value", at.alias("at"), (at + 1).alias("after"))
    pairs = ordered.overlap_join(signups, clicks, ("a", "b"), ("at", "after"), smallest=_HOUR)
    return pairs.groupBy("signup").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


_LINE = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query("window_running_sum", f"""select l_orderkey, l_linenumber, l_partkey, row_number() over w as nth, sum(l_quantity) over w as upto
from lineitem window w as (order by {_LINE} rows unbounded preceding)""")
def window_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global order over all line items: their number and the quantity shipped up to each."""
    lines = table(spark, sf_dir, "lineitem").select(*_LINE.split(", "), "l_quantity")
    out = ordered.running(lines, _LINE.split(", "), sums={"upto": F.col("l_quantity")}, number="nth")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "nth", "upto")


@query("window_key_running", """select event_id, row_number() over w as nth, (sum(event_id) over w)::bigint as upto from events
window w as (partition by event_type order by ts desc, event_id rows unbounded preceding)""")
def window_key_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type (five hot keys), newest first."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return ordered.running(events, [("ts", "desc"), "event_id"], keys=["event_type"], sums={"upto": F.col("event_id")}, number="nth").select("event_id", "nth", "upto")


@query("window_global_rank", "select p_partkey, rank() over (order by p_size desc) as rank, dense_rank() over (order by p_size desc) as dense_rank from part")
def window_global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of all parts by size, of which there are few: long ties."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return ordered.ranks(parts, [("p_size", "desc")]).select("p_partkey", "rank", "dense_rank")


@query("window_key_rank", """select l_orderkey, l_linenumber, rank() over w as rank, dense_rank() over w as dense_rank from lineitem
window w as (partition by l_returnflag order by l_quantity, l_discount desc)""")
def window_key_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks per return flag (three hot keys) by quantity and discount."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_discount")
    out = ordered.ranks(lines, ["l_quantity", ("l_discount", "desc")], keys=["l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", "rank", "dense_rank")
