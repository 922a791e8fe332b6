"""Streaming queries: the given tables are read as file streams (``availableNow``),
processed per micro-batch, and the landed output is read back as the result.

Checkpoints and sinks live under the session's ``spark.checkpoint.dir``; each
call uses fresh folders, so every call processes the whole table once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import streaming as st
from ..operators import classify as nb
from ..operators.graph import parse_flights
from ..session import remove_scratch, scratch_path
from .ml_queries import hashed_model, nb_model, nb_oracle_sql
from .parse_queries import flight_lines
from .registry import query, table

_E = """
with f as (select user_id src, cast(json_extract_string(props, '$.k') as bigint) dst from events)
"""


def _stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return st.read_stream(spark, f"{sf_dir.rstrip('/')}/{name}*.parquet", schema, max_files_per_trigger=max_files)


@query(
    "stream_count_per_batch",
    _E + "select number, count(*) n from "
    "(select src number from f union all select dst from f) group by 1",
)
def stream_count_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Up to 100 files per micro-batch: per-batch counts stay small, and a folder of
    # many files does not turn into as many tiny batches (each pays a fixed cost).
    events = _stream(spark, sf_dir, "events", max_files=100)
    lines = events.select(F.concat_ws(" ", F.col("user_id").cast("string"),
                                      F.get_json_object("props", "$.k")).alias("value"))
    sink, ckpt = scratch_path(spark, "counts"), scratch_path(spark, "counts-ckpt")
    st.count_per_batch(st.parse_numbers(lines), sink, ckpt, available_now=True)
    per_batch = spark.read.parquet(sink)
    return per_batch.groupBy("number").agg(F.sum("n").cast("long").alias("n"))


_BAD_TOKENS = ("x", "99999999999999999999")


@query("stream_rejected_counts", """select batch_id, sum(ok)::bigint accepted, sum(bad)::bigint rejected from
(select event_id % 3 batch_id, 2 + (event_id % 5 = 0)::int ok, 1 + (event_id % 7 = 0)::int bad from events) group by 1""")
def stream_rejected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines with numbers beyond an int and bad tokens, in three arrivals; the
    same checkpoint each time, so each run takes the new files only."""
    sink = _count_arrivals(spark, sf_dir)
    return st.rejected_per_batch(spark.read.parquet(sink))


@query("stream_count_batches", """select batch_id, number, count(*) n from (
select event_id % 3 batch_id, user_id number from events union all select event_id % 3, user_id + 4000000000 from events
union all select event_id % 3, 7 from events where event_id % 5 = 0) group by 1, 2""")
def stream_count_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by batch; a running total would be larger from the second batch on."""
    counts = spark.read.parquet(_count_arrivals(spark, sf_dir))
    return counts.where("number is not null").select(F.col("batch_id").cast("long").alias("batch_id"), "number", "n")


def _count_arrivals(spark: SparkSession, sf_dir: str) -> str:
    events = table(spark, sf_dir, "events")
    line = F.concat_ws(
        "  ", F.col("user_id").cast("string"), (F.col("user_id") + 4_000_000_000).cast("string"), F.lit(_BAD_TOKENS[0]),
        F.when(F.col("event_id") % 7 == 0, F.lit(_BAD_TOKENS[1])), F.when(F.col("event_id") % 5 == 0, F.lit(" 7 ")),
    )
    folder, sink, ckpt = scratch_path(spark, "lines"), scratch_path(spark, "counts"), scratch_path(spark, "counts-ckpt")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).select(line.alias("value")).write.mode("append").text(folder)
        st.count_per_batch(st.parse_tokens(st.read_text_stream(spark, folder)), sink, ckpt, available_now=True)
    return sink


@query("stream_score_posts", nb_oracle_sql("where d.lang = 'en' and d.n_chars % 3 <> 0 and (contains(lower(d.text), 'the') or "
                                           "contains(lower(d.text), 'zz'))", keys="source author, text"))
def stream_score_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON posts, filtered by keyword, language and sensitivity; one label per
    post, with its text. Authors repeat."""
    docs = table(spark, sf_dir, "documents")
    post = F.struct(F.struct("lang", F.col("source").alias("name")).alias("user"), "text", (F.col("n_chars") % 3 == 0).alias("possiblySensitive"))
    folder = scratch_path(spark, "posts")
    docs.select(F.to_json(post).alias("value")).write.text(folder)
    model = nb_model(spark, sf_dir)
    posts = st.filter_posts(st.read_posts(spark, folder, keywords=["the", "ZZ"]), lang="en")
    sink, ckpt = scratch_path(spark, "post-scores"), scratch_path(spark, "post-scores-ckpt")

    def scorer(batch: DataFrame) -> DataFrame:
        return nb.predict_tables(model, batch, text="text", prediction="pred", keep=["name", "text"])

    st.score(posts, scorer, sink, ckpt, available_now=True)
    return spark.read.parquet(sink).select(F.col("name").alias("author"), "text", "pred")


@query("stream_score", nb_oracle_sql("where d.lang = 'en'"))
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = nb_model(spark, sf_dir)
    docs = _stream(spark, sf_dir, "documents")
    posts = st.filter_posts(docs, lang="en", lang_col="lang", sensitive_col=None, name_col="doc_id")
    sink, ckpt = scratch_path(spark, "scores"), scratch_path(spark, "scores-ckpt")

    def scorer(batch: DataFrame) -> DataFrame:
        return nb.predict_tables(model, batch, doc="name", text="text", prediction="pred")

    st.score(posts, scorer, sink, ckpt, available_now=True)
    return spark.read.parquet(sink).select(F.col("name").alias("doc_id"), "pred")


@query("stream_score_hashed")
def stream_score_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 with the hashed model: each micro-batch is scored against its table."""
    model = hashed_model(spark, sf_dir)
    posts = st.filter_posts(_stream(spark, sf_dir, "documents"), lang="en", lang_col="lang", sensitive_col=None, name_col="doc_id")
    sink, ckpt = scratch_path(spark, "scores-hashed"), scratch_path(spark, "scores-hashed-ckpt")
    st.score(posts, lambda batch: nb.predict_tables(model, batch, doc="name", prediction="pred"), sink, ckpt, available_now=True)
    return spark.read.parquet(sink).select(F.col("name").alias("doc_id"), "pred")


@query("stream_score_hashed_facts", "select count(*) n, count(distinct doc_id) n_docs from documents where lang = 'en'")
def stream_score_hashed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per English document."""
    scored = stream_score_hashed(spark, sf_dir).where("pred in (0, 1)")
    return scored.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


_ETL_COLUMNS = [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string")]


def _run_etl(spark: SparkSession, sf_dir: str, table: str | None = None) -> str:
    path, ckpt = scratch_path(spark, "etl"), scratch_path(spark, "etl-ckpt")
    if table is not None:
        st.create_partitioned_table(spark, table, path, _ETL_COLUMNS, [*st.ETL_PARTITIONS, "batch_id"])
    events = _stream(spark, sf_dir, "events")
    st.partitioned_etl(events, path, "ts", [c for c, _ in _ETL_COLUMNS], ckpt, table=table, available_now=True)
    return path


@query(
    "stream_partitioned_etl",
    "select event_id, user_id, event_type, strftime(ts, '%Y') depYear, strftime(ts, '%m') depMonth, "
    "strftime(ts, '%d') depDay from events",
)
def stream_partitioned_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _run_etl(spark, sf_dir)
    back = st.read_partitioned(spark, path, _ETL_COLUMNS)
    return back.select("event_id", "user_id", "event_type", *st.ETL_PARTITIONS)


@query(
    "etl_partitions",
    "select strftime(ts, '%Y') y, strftime(ts, '%m') m, strftime(ts, '%d') d, count(*) n from events group by 1, 2, 3",
)
def etl_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + K6: a partitioned catalog table fed by the stream; every batch registers its
    own partitions; rows counted per day through the catalog."""
    return _through_catalog(
        spark, sf_dir,
        lambda name: spark.table(name).groupBy(F.col("depYear").alias("y"), F.col("depMonth").alias("m"), F.col("depDay").alias("d")).agg(F.count(F.lit(1)).alias("n")),
    )


@query(
    "etl_list_partitions",
    "select distinct strftime(ts, '%Y') \"depYear\", strftime(ts, '%m') \"depMonth\", strftime(ts, '%d') \"depDay\" from events",
)
def etl_list_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the days that the catalog lists after the load."""
    return _through_catalog(spark, sf_dir, lambda name: st.list_partitions(spark, name).select(*st.ETL_PARTITIONS).distinct())


def _through_catalog(spark: SparkSession, sf_dir: str, look) -> DataFrame:
    """Load a catalog table, look at it, and drop its entry again."""
    name = f"kestrel_flights_{uuid.uuid4().hex[:10]}"
    path, out = _run_etl(spark, sf_dir, table=name), scratch_path(spark, "etl-look")
    try:
        look(name).write.parquet(out)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    remove_scratch(spark, path)
    return spark.read.parquet(out)


_FLIGHT_COLUMNS = [("FlightNum", "string"), ("Origin", "string"), ("Dest", "string"), ("Note", "string")]


@query(
    "stream_flight_etl",
    """select cast(event_id as varchar) "FlightNum", cast(user_id as varchar) "Origin", json_extract_string(props, '$.k') "Dest",
    case event_id % 4 when 0 then 'null' when 1 then null when 2 then 'a|"b' || chr(10) || ' c ' else '' end "Note",
    strftime(ts, '%Y') "depYear", strftime(ts, '%m') "depMonth", strftime(ts, '%d') "depDay" from events""",
)
def stream_flight_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight lines as a text stream -> 29 columns -> day partitions; notes with line
    breaks, quotes, separators, blanks, empty and null survive."""
    folder = scratch_path(spark, "flight-lines")
    flight_lines(spark, sf_dir).write.text(folder)
    flights = parse_flights(st.read_text_stream(spark, folder), header_token="Year")
    day = F.make_date(F.col("Year").cast("int"), F.col("Month").cast("int"), F.col("DayofMonth").cast("int"))
    kind = F.col("FlightNum").cast("long") % 4
    note = F.when(kind == 0, "null").when(kind == 2, 'a|"b\n c ').when(kind == 3, "")
    path, ckpt = scratch_path(spark, "flights"), scratch_path(spark, "flights-ckpt")
    st.partitioned_etl(flights.withColumns({"day": day, "Note": note}), path, "day", [c for c, _ in _FLIGHT_COLUMNS], ckpt, available_now=True)
    return st.read_partitioned(spark, path, _FLIGHT_COLUMNS).select(*[c for c, _ in _FLIGHT_COLUMNS], *st.ETL_PARTITIONS)
