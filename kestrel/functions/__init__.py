"""Column expressions used by the operators (built-in Spark functions only)."""

from .convert import date_parts, element, empty_as, join_fields, route_text, to_type
from .text import (
    JAVA_SPACE_CLASS,
    JVM_TRIM_CHARS,
    basename,
    collapse_newlines,
    decode_file_name,
    jvm_trim,
    keyword_match,
    normalize,
    split_whitespace,
    split_words,
    tokenize,
)

__all__ = [
    "JAVA_SPACE_CLASS",
    "JVM_TRIM_CHARS",
    "basename",
    "collapse_newlines",
    "date_parts",
    "decode_file_name",
    "element",
    "empty_as",
    "join_fields",
    "jvm_trim",
    "keyword_match",
    "normalize",
    "route_text",
    "split_whitespace",
    "split_words",
    "to_type",
    "tokenize",
]
