"""Crawl + inverted index queries on ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import basename, normalize
from ..operators import text as tx
from ..session import scratch_path
from ..sources import format_pairs, parse_pairs, read_documents, read_lines, stop_words_frame, write
from ..sources.stopwords import SPANISH_STOP_WORDS
from .registry import query, table

#: Files of one scan of the whole-file reader in crawl_files, and of one folder (more than 32 folders are listed by tasks).
FILES_PER_READ, FILES_PER_FOLDER = 100_000, 2_000


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words))


_TRIM_SQL = "regexp_replace({}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
_NORMALIZE_SQL = "regexp_replace(" + _TRIM_SQL.format("text") + ", '[ \\t\\n\\x0B\\f\\r]*\\n[ \\t\\n\\x0B\\f\\r]*', ' ', 'g')"

_COUNTS_SQL = f"""
with t as (select doc_id, unnest(regexp_split_to_array(lower(text), '[^\\w'']')) word from documents),
c as (select word, doc_id, count(*) n from t where word not in ({_sql_list(SPANISH_STOP_WORDS)}) group by 1, 2)
"""


@query("crawl_normalize", f"select doc_id, {_NORMALIZE_SQL} as text from documents")
def crawl_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalize("text").alias("text"))


@query("crawl_files", f"select doc_id, {_NORMALIZE_SQL} as text, 1::bigint as n_of_name from documents")
def crawl_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 end to end: every document lands as a file of its own under one folder of the shared
    folder; the folder is read back one row per file and crawled, and file names are compared.

    The write only lays out the input the whole-file reader expects (folders with
    one file per document, the id on the first line); on real data they already exist
    and only the read + crawl part runs. The rows are dealt over all cores first, and each
    task writes its own files. A row's file and folder follow from its place in the table, so a
    repeated task writes the same ones. The driver holds a scan's list of files: the folders are
    read in batches of about ``FILES_PER_READ`` files, listed by the tasks. The files are
    opened once: the crawl is written, then counted.
    """
    path, crawl_path = scratch_path(spark, "crawl-files"), scratch_path(spark, "crawled")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    docs = table(spark, sf_dir, "documents", spread=False)
    n = docs.count()
    batches, folders = max(1, -(-n // FILES_PER_READ)), max(1, -(-min(n, FILES_PER_READ) // FILES_PER_FOLDER))
    line = F.concat_ws("\n", F.col("doc_id").cast("string"), "text").alias("value")
    lines = docs.select(F.monotonically_increasing_id().alias("place"), line)
    deal = F.xxhash64("place")
    lines = lines.select(
        F.pmod(deal, F.lit(batches)).alias("batch"),
        F.pmod(F.shiftright(deal, 32), F.lit(folders)).alias("folder"),
        F.format_string("%d.txt", "place").alias("file"),
        "value",
    ).repartition(tasks, "file")
    write(lines, path, fmt="text", partition_by=["batch", "folder"], file_names="file")
    for batch in range(batches):
        files = read_documents(spark, f"{path}/batch={batch}/*" if n else path)
        split = F.instr("text", "\n")
        named = files.select("name", F.substring_index("text", "\n", 1).cast("long").alias("doc_id"), F.substr("text", split + 1).alias("text"))
        crawled = tx.crawl(named)
        write(crawled.coalesce(tasks), f"{crawl_path}/{batch}")  # Spark gives a task a few dozen small files only
    crawled = spark.read.schema(crawled.schema).parquet(f"{crawl_path}/*")
    names = crawled.groupBy("name").agg(F.count("*").alias("n_of_name"))
    return crawled.join(names, "name").select("doc_id", "text", "n_of_name")


@query("crawl_basename", "select page_id, " + _TRIM_SQL.format("regexp_extract(url, '[^/]*$')") + " as name from pages")
def crawl_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", basename("url").alias("name"))


@query(
    "crawl_pages",
    "select page_id, " + _TRIM_SQL.format("regexp_extract(url, '[^/]*$')") + " as name, "
    + _NORMALIZE_SQL.replace("(text", "(html") + " as text from pages",
)
def crawl_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl step on web pages: base name of the URL and the page on one line."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("name"), F.col("html").alias("text"))
    return tx.crawl(pages)


@query("index_counts", _COUNTS_SQL + "select word, doc_id, n from c")
def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tx.term_counts(docs, doc="doc_id", text="text")


_UNICODE_COUNTS_SQL = _COUNTS_SQL.replace("'[^\\w'']'", "'[^\\p{L}\\p{N}_'']'")


@query("index_counts_unicode", _UNICODE_COUNTS_SQL + "select word, doc_id, n from c")
def index_counts_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7 option: letters of every script stay in one token (accented stop words can match)."""
    docs = table(spark, sf_dir, "documents")
    return tx.term_counts(docs, doc="doc_id", text="text", unicode=True)


@query(
    "index_postings",
    _COUNTS_SQL
    + f"""select word, doc_id // {tx.DEFAULT_BLOCK_SIZE} as block,
string_agg('(' || doc_id || ',' || n || ')', ', ' order by n desc, doc_id) postings from c group by 1, 2""",
)
def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = tx.term_counts(docs, doc="doc_id", text="text")
    return tx.postings(counts, doc="doc_id", sort=True)


@query(
    "crawl_pairs_roundtrip",
    f"select cast(doc_id as varchar) name, lower({_NORMALIZE_SQL}) as text, true as ok from documents",
)
def crawl_pairs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 text format + S10: crawl lines ``(name,text)`` written as text files, read and parsed back."""
    docs = table(spark, sf_dir, "documents")
    crawled = docs.select(F.col("doc_id").cast("string").alias("name"), normalize("text").alias("text"))
    path = scratch_path(spark, "pairs")
    write(format_pairs(crawled), path, fmt="text")
    return parse_pairs(read_lines(spark, path, line_sep="\n")).select("name", "text", "ok")


@query("index_counts_stop_table", _COUNTS_SQL + "select word, doc_id, n from c")
def index_counts_stop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop words as a table (anti-join) instead of a list."""
    docs = table(spark, sf_dir, "documents")
    return tx.term_counts(docs, doc="doc_id", text="text", stop_words=stop_words_frame(spark))


@query(
    "index_postings_blocks",
    _COUNTS_SQL
    + """select word, doc_id // 50 as block,
string_agg('(' || doc_id || ',' || n || ')', ', ' order by n desc, doc_id) postings from c group by 1, 2""",
)
def index_postings_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: frequent words have several blocks of at most 50 documents."""
    counts = tx.term_counts(table(spark, sf_dir, "documents"), doc="doc_id", text="text", block_size=50)
    return tx.postings(counts, doc="doc_id", block_size=50, dealt=True)


@query(
    "index_postings_ranked",
    _COUNTS_SQL
    + """, k as (select *, (row_number() over (partition by word order by doc) - 1) // 20 block from (select word, (doc_id * 2654435761) % 4294967296 doc, n from c))
select word, block, string_agg('(' || doc || ',' || n || ')', ', ' order by n desc, doc) postings from k group by 1, 2""",
)
def index_postings_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 / O9 with scattered document numbers: blocks by rank are full, blocks by number would hold one each."""
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id") * 2654435761 % 4294967296)
    lists = tx.term_lists(docs, doc="doc_id", text="text")
    return tx.postings(lists, block_size=20, by_rank=True, dealt=True)
