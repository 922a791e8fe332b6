"""From raw documents to training shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage calls one operator of ``kestrel.llm``; its result is written as Parquet
and read back as the next stage's documents.

A stage's input folder is removed when the next stage's is written.

Defined results: a document with null or empty text is rejected by the quality rules (it has
too few words); a null id, source or other column is kept; repeated rows are one document after
the second stage (the row with the smallest hash of all columns); equally small ids are told apart by their texts' hashes; an empty table goes
through all stages; extra columns pass through whatever their names (the last stage's columns
get leading underscores where a document column is called ``shard`` or ``slot``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, mixing, quality, sharding, simhash
from kestrel.llm.common import table
from kestrel.session import remove_scratch, scratch_path

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that fails a rule of policy v2."""
    rows = quality.ledger(docs, "text", keep=docs.columns)
    return rows.where(quality.passes("v2", rows.columns[-1])).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group (3-word shingles, at most 2 differing bits)."""
    return simhash.keep_one(docs, shingle=3, max_distance=2).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that contains 80 % of a benchmark item's 5-word shingles."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources to their target weights; a document drawn twice is two rows."""
    return mixing.mix(docs).select(*docs.columns)


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every row in one of 40 shards of near equal bytes; equal texts stay together."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    return sharding.shard(docs, SHARDS, key=F.col("text"), size=size)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_benchmark_leaks", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("shard_rows", shard_rows),
]

#: The mix draws with seeded random numbers: SQL cannot express it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:  # nothing reads the stage's input any more
            remove_scratch(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
