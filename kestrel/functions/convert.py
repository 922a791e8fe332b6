"""Value conversion and formatting (F8-F13), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import jvm_trim


def to_type(c, dtype: str, strict: bool = False) -> Column:
    """F8: string to a type. Strict raises on bad input (ANSI ``cast``), lenient gives null."""
    col = as_col(c)
    return col.cast(dtype) if strict else col.try_cast(dtype)


def empty_as(c, dtype: str, default, strict: bool = False) -> Column:
    """An empty (or blank) field becomes ``default``; other values are converted."""
    value = F.nullif(jvm_trim(c), F.lit(""))
    return F.coalesce(to_type(value, dtype, strict), F.lit(default).cast(dtype))


def element(arr, i: int) -> Column:
    """0-based array element, null when the array is shorter (never raises)."""
    return F.get(as_col(arr), i)


def route_text(src, dst, n) -> Column:
    """``"src -> dst: n"``."""
    return F.format_string("%s -> %s: %d", as_col(src), as_col(dst), as_col(n))


def date_parts(ts) -> list[Column]:
    """zero-padded year, month, day strings of a timestamp/date."""
    col = as_col(ts)
    return [F.date_format(col, "yyyy"), F.date_format(col, "MM"), F.date_format(col, "dd")]


def join_fields(cols, sep: str = "|") -> Column:
    """one delimited line from several columns; nulls print as ``null`` like the JVM."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("null")) for c in cols])
