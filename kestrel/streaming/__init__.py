"""Structured Streaming jobs: sources, per-batch jobs and the partitioned ETL."""

from .catalog import add_partitions, create_partitioned_table, list_partitions, repair
from .jobs import (
    ETL_PARTITIONS,
    count_batch,
    count_per_batch,
    land_batch,
    parse_numbers,
    parse_tokens,
    partitioned_etl,
    read_partitioned,
    rejected_per_batch,
    run,
    score,
)
from .state import MERGE_SESSIONS, distinct, interval_join, late_rows, results, running_counts, sessions, windows
from .sources import (
    POST_SCHEMA,
    filter_posts,
    parse_posts,
    read_posts,
    read_posts_kafka,
    read_socket,
    read_stream,
    read_text_stream,
)

__all__ = [
    "add_partitions",
    "ETL_PARTITIONS",
    "MERGE_SESSIONS",
    "POST_SCHEMA",
    "count_batch",
    "count_per_batch",
    "create_partitioned_table",
    "distinct",
    "filter_posts",
    "interval_join",
    "late_rows",
    "land_batch",
    "list_partitions",
    "parse_numbers",
    "parse_tokens",
    "parse_posts",
    "partitioned_etl",
    "read_partitioned",
    "rejected_per_batch",
    "read_posts",
    "read_posts_kafka",
    "read_socket",
    "read_stream",
    "read_text_stream",
    "repair",
    "results",
    "run",
    "running_counts",
    "score",
    "sessions",
    "windows",
]
