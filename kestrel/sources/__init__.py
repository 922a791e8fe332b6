"""Sources, parsers and sinks."""

from .files import (
    CSV_EXACT,
    CSV_RECORDS,
    format_pairs,
    read_csv,
    read_csv_records,
    read_csv_strings,
    read_documents,
    read_lines,
    write,
    write_csv_records,
)
from .parsers import (
    MOVIE_SCHEMA,
    RATING_SCHEMA,
    parse_delimited,
    parse_movies,
    parse_pairs,
    parse_ratings,
    parse_vectors,
)
from .stopwords import SPANISH_STOP_WORDS, stop_words_frame

__all__ = [
    "CSV_EXACT",
    "CSV_RECORDS",
    "MOVIE_SCHEMA",
    "RATING_SCHEMA",
    "SPANISH_STOP_WORDS",
    "format_pairs",
    "parse_delimited",
    "parse_movies",
    "parse_pairs",
    "parse_ratings",
    "parse_vectors",
    "read_csv",
    "read_csv_records",
    "read_csv_strings",
    "read_documents",
    "read_lines",
    "stop_words_frame",
    "write",
    "write_csv_records",
]
