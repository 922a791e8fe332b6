"""Stateful stream queries: ``events`` arrive in three parts, some rows one part too late, some
without time, some twice; each part is one run of the job on the same checkpoint, so every query
also restarts from its stored state. The results are read back from the job's output.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming as st
from ..session import scratch_path
from .registry import query, table

PARTS = 3
DELAY = timedelta(days=2)
_DELAY_MS = DELAY // timedelta(milliseconds=1)

# t: every arriving row with its part ``a``; w: the watermark (ms) that holds when part a arrives, 3 = at the end.
_ARRIVALS = f"""
t as (select event_id, user_id, event_type, value, case when event_id % 97 = 0 then null else ts end ts,
  least(2, (day(ts) - 1) // 10 + (event_id % 11 = 0)::int) a from events),
w as (select x.a, greatest(0, coalesce((select max(epoch_ms(ts)) - {_DELAY_MS} from t where t.a < x.a), 0)) * 1000 wm
  from (values (0), (1), (2), (3)) x(a)),
o as (select t.*, epoch_us(ts) us, wm from t join w on t.a = w.a)
"""


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    late = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    part = F.least(F.lit(PARTS - 1), F.expr("(day(ts) - 1) div 10") + late)
    at = F.when(F.col("event_id") % 97 != 0, F.col("ts")).cast("timestamp")
    return events.select("event_id", "user_id", "event_type", "value", at.alias("ts"), part.cast("int").alias("part"))


#: Rows of a part per state store, about.
STORE_ROWS = 50_000


def _play(spark: SparkSession, rows: DataFrame, job: Callable[..., object]) -> str:
    """Run ``job(stream, out, checkpoint, state_partitions=n)`` once per part; the output folder."""
    stores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(4, rows.count() // (PARTS * STORE_ROWS)))
    folder, out, ckpt = (scratch_path(spark, x) for x in ("arrivals", "state", "state-ckpt"))
    schema = rows.drop("part").schema
    for part in range(PARTS):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        job(st.read_stream(spark, folder, schema), out, ckpt, available_now=True, state_partitions=stores)
    return out


def _ntz(*cols: str) -> list:
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in cols]


def _aggs() -> list:
    return [F.count(F.lit(1)).alias("n"), F.max("value").alias("top")]


def _tumbling(spark: SparkSession, sf_dir: str) -> str:
    return _play(spark, _arriving(spark, sf_dir), lambda s, out, ckpt, **how: st.windows(
        s, "ts", ["event_type"], _aggs(), timedelta(hours=6), out, ckpt, delay=DELAY, **how))


_H6 = 6 * 3_600_000_000


@query("stream_tumbling_windows", f"""with {_ARRIVALS}
select event_type, make_timestamp(us - us % {_H6}) window_start, make_timestamp(us - us % {_H6} + {_H6}) window_end,
  count(*) n, max(value) top from o where us - us % {_H6} + {_H6} > wm and us - us % {_H6} + {_H6} <= (select max(wm) from w) group by 1, 2, 3""")
def stream_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and maxima per type and six hours, each window emitted once, when the watermark closes it."""
    out = st.results(spark, _tumbling(spark, sf_dir))
    return out.select("event_type", *_ntz("window_start", "window_end"), "n", "top")


@query("stream_late_rows", f"""with {_ARRIVALS}
select event_id, case when ts is null then 'no_time' else 'late' end kind, (ts is not null)::int missed
from o where ts is null or us - us % {_H6} + {_H6} <= wm""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output of the tumbling windows: rows whose window had closed, and rows without time."""
    return st.late_rows(spark, _tumbling(spark, sf_dir)).select("event_id", "kind", "missed")


_H4, _H10 = 4 * 3_600_000_000, 10 * 3_600_000_000


@query("stream_sliding_windows", f"""with {_ARRIVALS},
x as (select event_type, value, wm, us, us - us % {_H4} - k * {_H4} s from o, (values (0), (1), (2)) y(k) where us - us % {_H4} - k * {_H4} + {_H10} > us)
select event_type, make_timestamp(s) window_start, make_timestamp(s + {_H10}) window_end, count(*) n, max(value) top
from x where s + {_H10} > wm and s + {_H10} <= (select max(wm) from w) group by 1, 2, 3""")
def stream_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten hours every four hours; a late row still counts in its windows that are open."""
    out = _play(spark, _arriving(spark, sf_dir), lambda s, out, ckpt, **how: st.windows(
        s, "ts", ["event_type"], _aggs(), timedelta(hours=10), out, ckpt, slide=timedelta(hours=4), delay=DELAY, **how))
    return st.results(spark, out).select("event_type", *_ntz("window_start", "window_end"), "n", "top")


_GAP = 12 * 3_600_000_000


def _sessions_sql() -> str:
    """Part by part: sessions of the rows still open and the part's rows that are on time."""
    ctes = ["r0 as (select user_id, us from o where false)"]
    for a in range(PARTS):
        ctes.append(f"""i{a} as (select user_id, us, sum(coalesce(fresh, 0)) over (partition by user_id order by us rows unbounded preceding) s from (
  select *, (us - lag(us) over (partition by user_id order by us) >= {_GAP})::int fresh from (
    select user_id, us from r{a} union all select user_id, us from o where a = {a} and us + {_GAP} > wm)))""")
        ctes.append(f"e{a} as (select user_id, s, min(us) lo, max(us) + {_GAP} hi, count(*) n from i{a} group by 1, 2)")
        done = f"(select wm from w where a = {a + 1})"
        ctes.append(f"d{a} as (select * from e{a} where hi <= {done})")
        ctes.append(f"r{a + 1} as (select i{a}.user_id, us from i{a} join e{a} on i{a}.user_id = e{a}.user_id and i{a}.s = e{a}.s and hi > {done})")
    found = " union all ".join(f"select * from d{a}" for a in range(PARTS))
    return f"with {_ARRIVALS}, {', '.join(ctes)} select user_id, make_timestamp(lo) window_start, make_timestamp(hi) window_end, n from ({found})"


@query("stream_session_windows", _sessions_sql())
def stream_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user: rows less than twelve hours apart."""
    out = _play(spark, _arriving(spark, sf_dir), lambda s, out, ckpt, **how: st.sessions(
        s, "ts", ["user_id"], [F.count(F.lit(1)).alias("n")], timedelta(hours=12), out, ckpt, delay=DELAY, **how))
    return st.results(spark, out).select("user_id", *_ntz("window_start", "window_end"), "n")


_MINUTE, _IDLE = 60_000_000, 2 * 86_400_000_000


def _running_sql() -> str:
    """Part by part: state, counts emitted, keys closed by the watermark after the part."""
    ticks = _ARRIVALS.replace("max(epoch_ms(ts))", "max((epoch_us(ts) // 60000000 + 1) * 60000)")
    ctes = [f"k as (select user_id, a, count(*) n, max(us - us % {_MINUTE} + {_MINUTE}) last from o where us - us % {_MINUTE} + {_MINUTE} > wm group by 1, 2)",
            "s0 as (select user_id, n, last from k where false)"]
    for a in range(PARTS):
        done = f"(select wm from w where a = {a + 1})"
        ctes.append(f"""u{a} as (select coalesce(s.user_id, k.user_id) user_id, coalesce(s.n, 0) + coalesce(k.n, 0) n, greatest(s.last, k.last) last, k.n is not null seen
  from s{a} s full join (select * from k where a = {a}) k on s.user_id = k.user_id)""")
        ctes.append(f"c{a} as (select user_id, n, last from u{a} where last + {_IDLE} < {done})")
        ctes.append(f"s{a + 1} as (select user_id, n, last from u{a} where last + {_IDLE} >= {done})")
    found = " union all ".join(f"select user_id, n, last, false closed from u{a} where seen union all select *, true from c{a}" for a in range(PARTS))
    return f"with {ticks}, {', '.join(ctes)} select user_id, n, make_timestamp(last) \"last\", closed from ({found})"


@query("stream_running_counts", _running_sql())
def stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts per user over all parts; a user idle for two days is closed and starts anew."""
    out = _play(spark, _arriving(spark, sf_dir), lambda s, out, ckpt, **how: st.running_counts(
        s, "ts", "user_id", timedelta(days=2), out, ckpt, delay=DELAY, **how))
    return st.results(spark, out).select("user_id", "n", *_ntz("last"), "closed")


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _arriving(spark, sf_dir)
    again = rows.where("event_id % 5 = 0").withColumn("part", F.least(F.lit(PARTS - 1), F.col("part") + 1))
    hot = rows.where("event_id % 500 = 1").withColumn("part", F.explode(F.array_repeat("part", 200)))
    return rows.unionByName(again).unionByName(hot)


@query("stream_distinct_events", f"""with {_ARRIVALS}
select event_id, event_type, 1::bigint n from o where us > wm""")
def stream_distinct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event once, though a fifth comes again with the next part and some come 200 times."""
    out = _play(spark, _replayed(spark, sf_dir), lambda s, out, ckpt, **how: st.distinct(s, "ts", ["event_id"], out, ckpt, delay=DELAY, **how))
    return st.results(spark, out).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


_WITHIN = 2 * 86_400_000_000
_JOIN_SQL = _ARRIVALS.replace(
    f"(select max(epoch_ms(ts)) - {_DELAY_MS} from t where t.a < x.a)",
    f"(select min(m) - {_DELAY_MS} from (select max(epoch_ms(ts)) m from t where t.a < x.a and event_type in ('click', 'purchase') group by event_type))",
)


@query("stream_interval_join", f"""with {_JOIN_SQL},
l as (select * from o where event_type = 'click' and us > wm), r as (select * from o where event_type = 'purchase' and us > wm),
p as (select l.event_id click_id, r.event_id purchase_id, l.us from l left join r on l.user_id = r.user_id and r.us between l.us and l.us + {_WITHIN})
select click_id, purchase_id from p where purchase_id is not null or us + {_WITHIN} < (select max(wm) from w)""")
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each click with the user's purchases in the two days after it; clicks without one once their time is over."""

    def job(stream: DataFrame, out: str, ckpt: str, **how) -> None:
        clicks = stream.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
        buys = stream.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
        st.interval_join(clicks, buys, ["user_id"], "click_ts", "purchase_ts", timedelta(0), timedelta(days=2), out, ckpt,
                         how="left_outer", delay=DELAY, **how)

    return st.results(spark, _play(spark, _arriving(spark, sf_dir), job)).select("click_id", "purchase_id")


@query("stream_timed_run", "select user_id number, count(*) n from events group by 1")
def stream_timed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches every second, stopped after a set time, started again where they stopped;
    a last run takes whatever is left. Every row counts once however the runs cut the table."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("value"), (F.col("event_id") % 4).alias("part"))
    folder, sink, ckpt = (scratch_path(spark, x) for x in ("lines", "timed", "timed-ckpt"))
    for part in range(4):
        rows.where(F.col("part") == part).select("value").write.mode("append").text(folder)
        lines = st.read_text_stream(spark, folder, max_files_per_trigger=1)
        if part % 2:
            st.count_per_batch(st.parse_tokens(lines), sink, ckpt, interval="1 second", timeout_s=2.5)
    st.count_per_batch(st.parse_tokens(st.read_text_stream(spark, folder)), sink, ckpt, available_now=True)
    return spark.read.parquet(sink).groupBy("number").agg(F.sum("n").cast("long").alias("n"))
