"""Registered queries over the given tables and their DuckDB oracle SQL."""

from .registry import ORACLE_SQL, QUERIES, table


def _load_all() -> None:
    # Importing the modules registers their queries.
    from . import (  # noqa: F401
        aggregate_queries,
        graph_queries,
        ml_queries,
        ordered_queries,
        parse_queries,
        relational_queries,
        state_queries,
        stream_queries,
        text_queries,
    )


_load_all()

__all__ = ["ORACLE_SQL", "QUERIES", "table"]
