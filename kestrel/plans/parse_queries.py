"""Parser round trips: rows of the given tables are printed as delimited text lines
(the formats the original jobs read) and parsed back with :mod:`kestrel.sources`.
The work grows with the tables; the oracle is the table itself."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import join_fields
from ..operators import graph as g
from ..operators import recommend as rec
from ..session import scratch_path
from ..sources import (
    CSV_EXACT,
    parse_delimited,
    parse_movies,
    parse_ratings,
    parse_vectors,
    read_csv,
    read_csv_records,
    read_csv_strings,
    read_lines,
    write,
    write_csv_records,
)
from .registry import query, table


def _with_header(spark: SparkSession, lines: DataFrame, header: str) -> DataFrame:
    return spark.range(1).select(F.lit(header).alias("value")).unionByName(lines)


@query("parse_delimited", "select c_custkey, c_name, c_nationkey from customer")
def parse_delimited_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    lines = cust.select(F.concat_ws("|", "c_custkey", "c_name", "c_nationkey").alias("value"))
    lines = _with_header(spark, lines, "c_custkey|c_name|c_nationkey")
    return parse_delimited(lines, "c_custkey long, c_name string, c_nationkey int", sep="|", header_token="c_custkey")


@query(
    "parse_empty_default",
    "select c_custkey, case when c_nationkey % 2 = 0 then 0.0::double else c_nationkey::double end v from customer",
)
def parse_empty_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    field = F.when(F.col("c_nationkey") % 2 == 0, F.lit("")).otherwise(F.col("c_nationkey").cast("string"))
    lines = cust.select(F.concat_ws(",", F.col("c_custkey").cast("string"), field).alias("value"))
    return parse_delimited(lines, "c_custkey long, v double", sep=",", empty_as_default={"v": 0.0})


@query(
    "parse_genres",
    "select cast(p_partkey as integer) movieId, p_name title, 2::bigint n, p_type || ',' || p_brand items from part",
)
def parse_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    lines = part.select(F.concat_ws("::", "p_partkey", "p_name", F.concat_ws("|", "p_type", "p_brand")).alias("value"))
    movies = parse_movies(lines)
    return movies.select("movieId", "title", F.size("genres").cast("long").alias("n"),
                         F.array_join("genres", ",").alias("items"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user::item::rating::timestamp`` lines: customer rates part, 1 + line number % 5."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.concat_ws("::", "o_custkey", "l_partkey", (F.lit(1) + F.col("l_linenumber") % 5).cast("string"),
                    F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("string")).alias("value")
    )


_RATINGS_SQL = """select cast(o_custkey as integer) userId, cast(l_partkey as integer) movieId,
cast(1 + l_linenumber % 5 as double) rating from lineitem join orders on l_orderkey = o_orderkey"""


@query("parse_ratings", _RATINGS_SQL)
def parse_ratings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ratings(rating_lines(spark, sf_dir), strict=True)


@query(
    "rating_stats",
    "select count(*) n_ratings, count(distinct userId) n_users, count(distinct movieId) n_items from ("
    + _RATINGS_SQL + ")",
)
def rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.rating_stats(parse_ratings(rating_lines(spark, sf_dir), strict=True))


_FLIGHT_LINE_FIELDS = {"Year": "yyyy", "Month": "M", "DayofMonth": "d"}


def flight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """29-field flight records (header first) from ``events``: origin = user, dest = ``props.k``."""
    ev = table(spark, sf_dir, "events")
    values = []
    for name in g.FLIGHT_FIELDS:
        if name in _FLIGHT_LINE_FIELDS:
            values.append(F.date_format("ts", _FLIGHT_LINE_FIELDS[name]))
        elif name == "Origin":
            values.append(F.col("user_id").cast("string"))
        elif name == "Dest":
            values.append(F.get_json_object("props", "$.k"))
        elif name == "FlightNum":
            values.append(F.col("event_id").cast("string"))
        else:
            values.append(F.lit(""))
    lines = ev.select(F.concat_ws(" , ", *values).alias("value"))
    return _with_header(spark, lines, ",".join(g.FLIGHT_FIELDS))


@query(
    "flights_top_routes",
    """with f as (select cast(user_id as varchar) src, cast(json_extract_string(props, '$.k') as varchar) dst
from events), e as (select src, dst, count(*) n from f group by 1, 2)
select src, dst, n, concat(src, ' -> ', dst, ': ', n) route from e order by n desc, src, dst limit 10""",
)
def flights_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = g.parse_flights(flight_lines(spark, sf_dir), header_token="first")
    return g.top_routes(g.edges(flights, "Origin", "Dest"), 10)


# --- CSV readers (S3, S4, P2): rows written as CSV to the shared folder, read back ---------------


@query(
    "csv_header_strings",
    "select cast(c_custkey as varchar) c_custkey, c_name, cast(c_nationkey as varchar) c_nationkey, "
    "c_mktsegment from customer",
)
def csv_header_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: CSV with a header row read back with every column a string (no inference)."""
    path = scratch_path(spark, "csv-header")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    write(cust, path, fmt="csv", header="true")
    return read_csv_strings(spark, path)


@query(
    "csv_positional",
    "select quality polarity, doc_id id, lang date, source query, cast(toxic as varchar) \"user\", text tweet from labels "
    "join documents using (doc_id)",
)
def csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless CSV of six columns (free text last) with an explicit schema, renamed by position."""
    path = scratch_path(spark, "csv-positional")
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    rows = labels.join(docs, "doc_id").select("quality", "doc_id", "lang", "source", "toxic", "text")
    write(rows, path, fmt="csv", **CSV_EXACT)
    schema = "_c0 int, _c1 long, _c2 string, _c3 string, _c4 string, _c5 string"
    return read_csv(spark, path, schema=schema, names=["polarity", "id", "date", "query", "user", "tweet"], **CSV_EXACT)


@query(
    "csv_records",
    """select doc_id, lang, case when doc_id % 9 <> 0 then source end source, 'a' || chr(30) || '"b|,' || chr(10) || chr(31) || 'e ' || text || chr(13) || chr(10) as text from documents""",
)
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text with line breaks, quotes and the control characters themselves, in files that can be split."""
    odd = F.concat(F.lit('a\x1e"b|,\n\x1fe '), F.col("text"), F.lit("\r\n"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("source"), odd.alias("text"))
    path = scratch_path(spark, "csv-records")
    write_csv_records(rows, path)
    return read_csv_records(spark, path, "doc_id long, lang string, source string, text string")


@query("read_lines_counts", """select line, count(*) n from (select unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)),
chr(13), chr(10)), chr(10))) line from documents) group by 1""")
def read_lines_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written to files, read back line by line, lines counted."""
    path = scratch_path(spark, "lines")
    write(table(spark, sf_dir, "documents").select("text"), path, fmt="text")
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("parse_vector_lines", """select vec_id, list_sum(embedding[1:4]::double[]) s, len(embedding) n, vec_id % 5 <> 0 good from embeddings""")
def parse_vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector lines with trailing blanks; every fifth line has a bad number, empty lines are dropped."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    text = F.concat(F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), " "), F.when(F.col("vec_id") % 5 == 0, " bad  ").otherwise("  "))
    lines = emb.select("vec_id", "embedding", text.alias("value")).unionByName(emb.select("vec_id", "embedding", F.lit("").alias("value")))
    parsed = parse_vectors(lines, keep=["vec_id", "embedding"], strict=False)
    x = F.when(F.col("features").isNotNull(), vector_to_array("features")).otherwise(F.col("embedding").cast("array<double>"))
    total = F.get(x, 0) + F.get(x, 1) + F.get(x, 2) + F.get(x, 3)
    return parsed.select("vec_id", total.alias("s"), F.size(x).cast("long").alias("n"), F.col("features").isNotNull().alias("good"))


@query("join_fields_lines", """select c_custkey, concat_ws('|', c_custkey, coalesce(nullif(c_name, 'x'), 'null'),
case when c_nationkey % 3 = 0 then 'null' else cast(c_nationkey as varchar) end) line from customer""")
def join_fields_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows printed as delimited lines, nulls as the text ``null``."""
    cust = table(spark, sf_dir, "customer")
    nation = F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey"))
    return cust.select("c_custkey", join_fields([F.col("c_custkey"), F.col("c_name"), nation]).alias("line"))
