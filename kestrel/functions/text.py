"""Column-level text functions (F1-F7). All are built-in Spark expressions.

Every function takes a column (or a column name) and returns a Column, so it
stays inside whole-stage code generation and never crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# JVM ``String.trim`` strips every code point <= U+0020 (control chars and space);
# Spark's ``trim`` only strips spaces, so we pass the set explicitly.
JVM_TRIM_CHARS = "".join(chr(c) for c in range(0x21))

# Java's ``\s`` (what the jobs' regexes meant). Spelled out so the same class can be
# used by engines whose ``\s`` differs (RE2 has no vertical tab).
JAVA_SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"
SPACE_CHARS = " \t\n\x0b\f\r"


def jvm_trim(c) -> Column:
    """trim like ``java.lang.String.trim`` (all chars <= U+0020)."""
    return F.btrim(as_col(c), F.lit(JVM_TRIM_CHARS))


def basename(c, sep: str = "/") -> Column:
    """text after the last separator, trimmed; the whole text when there is none."""
    return jvm_trim(F.substring_index(as_col(c), sep, -1))


def collapse_newlines(c) -> Column:
    """every newline with the whitespace around it becomes a single space.

    Line by line (split, trim, drop the empty ones, join): linear in the text, also
    for long runs of blanks. Whitespace at the text's ends is dropped with them.
    """
    lines = F.transform(F.split(as_col(c), "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)))
    return F.array_join(F.filter(lines, lambda x: x != F.lit("")), " ")


def normalize(c) -> Column:
    """F1 + F3: a whole document on one line (trim, then join its lines with one space)."""
    return collapse_newlines(jvm_trim(c))


def _jvm_parts(text: Column, pattern: str) -> Column:
    """JVM ``String.split``: trailing empty parts are dropped; an empty text has one empty part.

    The parts are computed once per row (bound to a lambda variable) and looked at from
    the end, so a long run of separators costs no more than its length.
    """

    def strip(parts: Column) -> Column:
        last = F.array_position(F.transform(F.reverse(parts), lambda x: x != F.lit("")), F.lit(True))
        kept = F.slice(parts, F.lit(1), (F.size(parts) - last + 1).cast("int"))
        empty = F.when(F.size(parts) == 1, parts).otherwise(F.array().cast("array<string>"))
        return F.when(last > 0, kept).otherwise(empty)

    return F.get(F.transform(F.array(F.split(text, pattern, -1)), strip), 0)


def decode_file_name(c) -> Column:
    """``_metadata.file_name`` is URL-encoded; turn it back into the plain name.

    A literal ``+`` must survive, so it is escaped before decoding.
    """
    col = as_col(c)
    return F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)


# the index tokenizer. ``\w`` is ASCII-only in Java regexes, as it was in the
# original jobs; ``unicode=True`` keeps letters of every script together.
ASCII_TOKEN_SPLIT = "[^\\w']"
UNICODE_TOKEN_SPLIT = "[^\\p{L}\\p{N}_']"


def tokenize(c, unicode: bool = False, jvm_empties: bool = True) -> Column:
    """F4 + F5: lower-case, trim, split on anything but word chars and apostrophes.

    Same tokens as JVM ``text.trim.split("[^\\w']")``: leading and inner empty
    tokens are kept, trailing empty tokens are dropped, and a text made only of
    delimiters gives no token. ``jvm_empties=False`` skips the pass that
    drops trailing empties: use it only when empty tokens are filtered anyway.
    """
    pattern = UNICODE_TOKEN_SPLIT if unicode else ASCII_TOKEN_SPLIT
    text = jvm_trim(F.lower(as_col(c)))
    if not jvm_empties:
        return F.split(text, pattern, -1)
    return _jvm_parts(text, pattern)


def split_words(c, sep: str = " ") -> Column:
    """M1 tokens: split on one literal separator exactly like JVM ``String.split``.

    The JVM drops trailing empty strings while Spark's ``split`` keeps them (H3).
    A text made only of separators gives no token at all on the JVM (every part is
    a trailing empty), an empty text gives one empty token. Inner empty tokens stay.
    """
    return _jvm_parts(as_col(c), "\\Q" + sep + "\\E")


def split_whitespace(c) -> Column:
    """Trim, then split on runs of whitespace (``line.trim.split("\\\\s+")``)."""
    return F.split(jvm_trim(c), f"{JAVA_SPACE_CLASS}+", -1)


def keyword_match(c, keywords: list[str] | None) -> Column:
    """Case-insensitive match of any keyword in the text (true when no keywords)."""
    if not keywords:
        return F.lit(True)
    cond = None
    low = F.lower(as_col(c))
    for k in keywords:
        term = F.contains(low, F.lit(k.lower()))
        cond = term if cond is None else (cond | term)
    return cond
