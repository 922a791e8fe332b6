"""Record parsers for text lines.

All parsing is built-in expressions over the ``value`` column: split, positional
``get`` (null when a record is short), trim and cast. ``strict=True`` uses ANSI
casts that fail the job on a bad value; the default is lenient (``try_cast``) and
an optional status column says whether every field of a row converted.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, _parse_datatype_string

from ..functions import element, empty_as, jvm_trim, split_words, to_type


def _schema(schema) -> StructType:
    return _parse_datatype_string(schema) if isinstance(schema, str) else schema


def _literal_regex(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def parse_delimited(
    df: DataFrame,
    schema: StructType | str,
    sep: str = ",",
    header_token: str | None = None,
    empty_as_default: dict | None = None,
    strict: bool = False,
    value: str = "value",
    status_col: str | None = None,
    trim_fields: bool = True,
) -> DataFrame:
    """Split each line on a literal ``sep`` and map fields by position.

    * ``header_token``: drop every row whose first field equals it (header rows;
      with ``"first"`` the first field of the first row is used, as the original
      flights job did with its ``first`` action).
    * ``empty_as_default``: ``{column: default}``; an empty field of that column
      becomes the default (the typed superhero parser turned empty numbers to 0.0).
    * Array-typed fields are split again on ``|`` (the movie genres list).
    """
    st = _schema(schema)
    fields = F.split(F.col(value), _literal_regex(sep), -1)
    parsed = df.select(fields.alias("_f"))

    if header_token == "first":
        probe = jvm_trim(element("_f", 0)) if trim_fields else element("_f", 0)
        first = parsed.select(probe.alias("h")).first()
        header_token = None if first is None else first["h"]
    if header_token is not None:
        first_field = element("_f", 0)
        if trim_fields:
            first_field = jvm_trim(first_field)
        parsed = parsed.where(~first_field.eqNullSafe(F.lit(header_token)))

    empty_as_default = empty_as_default or {}
    n = len(st.fields)
    cols: list[Column] = []
    checks: list[Column] = []
    for i, field in enumerate(st.fields):
        raw = element("_f", i)
        text = jvm_trim(raw) if trim_fields else raw
        out = _convert(text, field.dataType, field.name, empty_as_default, strict)
        if strict and i == 0:
            # A short record fails the job instead of silently yielding nulls.
            message = F.concat(F.lit(f"record has fewer than {n} fields: "), F.array_join("_f", sep))
            out = F.when(F.size("_f") < n, F.raise_error(message)).otherwise(out)
        cols.append(out.alias(field.name))
        checks.append(raw.isNotNull() & out.isNotNull())
    status = [_all(checks).alias(status_col)] if status_col else []
    return parsed.select(*cols, *status)


def _all(checks: list[Column]) -> Column:
    acc = F.lit(True)
    for c in checks:
        acc = acc & F.coalesce(c, F.lit(False))
    return acc


def _convert(text: Column, dtype: DataType, name: str, defaults: dict, strict: bool) -> Column:
    if isinstance(dtype, ArrayType):
        return F.split(text, "[|]", -1)
    type_name = dtype.simpleString()
    if name in defaults:
        return empty_as(text, type_name, defaults[name], strict)
    if type_name == "string":
        return text
    return to_type(text, type_name, strict)


RATING_SCHEMA = "userId int, movieId int, rating double"
MOVIE_SCHEMA = "movieId int, title string, genres array<string>"


def parse_ratings(df: DataFrame, sep: str = "::", strict: bool = False, value: str = "value") -> DataFrame:
    """``user::item::rating::timestamp`` -> ``(userId, movieId, rating)``; timestamp dropped."""
    return parse_delimited(df, RATING_SCHEMA, sep=sep, strict=strict, value=value, trim_fields=False)


def parse_movies(df: DataFrame, sep: str = "::", strict: bool = False, value: str = "value") -> DataFrame:
    """``item::title::g1|g2`` -> ``(movieId, title, genres array)``.

    Genres are split on a literal pipe (H2: the original regex split gave characters).
    """
    return parse_delimited(df, MOVIE_SCHEMA, sep=sep, strict=strict, value=value, trim_fields=False)


def parse_vectors(df: DataFrame, sep: str = " ", value: str = "value", strict: bool = True,
                  output: str = "features", keep: list[str] | None = None) -> DataFrame:
    """Drop empty lines, split on ``sep``, parse doubles into a dense vector column.

    Trailing separators are dropped as the JVM's ``split`` does (H3). ``strict=False``
    gives lines with a bad number a null vector instead of failing the job, so they
    stay countable. ``keep`` carries other columns (an id) through.
    """
    numbers = F.transform(split_words(value, sep), lambda x: x.cast("double") if strict else x.try_cast("double"))
    rows = df.where(F.length(value) > 0).select(*(keep or []), numbers.alias("_numbers"))
    good = F.size("_numbers") > 0
    if not strict:
        good = good & ~F.exists("_numbers", lambda x: x.isNull())
    # The vector function must not see a null number: bad lines hand it an empty array.
    plain = F.transform(F.when(good, F.col("_numbers")).otherwise(F.array().cast("array<double>")),
                        lambda x: F.coalesce(x, F.lit(0.0)))
    return rows.select(*(keep or []), F.when(good, array_to_vector(plain)).alias(output))


# The crawl's ``(name,text)`` line. The name stops at the first comma (H8); the text may
# hold any character, also those that a regex dot leaves out by default (CR, U+2028).
_PAIR_REGEX = "(?s)^\\(([^,]+),(.*)\\)[ \\t\\n\\x0B\\f\\r]*\\z"


def parse_pairs(df: DataFrame, value: str = "value") -> DataFrame:
    """``(name,text)`` lines -> ``(name, text, ok)``.

    ``name`` is trimmed, ``text`` lower-cased. A line that does not match gives
    ``("", "")`` with ``ok = false`` (the original printed it to stderr), so bad
    lines stay countable instead of vanishing silently.
    """
    v = F.col(value)
    ok = v.rlike(_PAIR_REGEX)
    return df.select(
        F.when(ok, jvm_trim(F.regexp_extract(v, _PAIR_REGEX, 1))).otherwise(F.lit("")).alias("name"),
        F.when(ok, F.lower(F.regexp_extract(v, _PAIR_REGEX, 2))).otherwise(F.lit("")).alias("text"),
        ok.alias("ok"),
    )
