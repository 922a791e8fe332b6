"""Crawl and inverted index (S1 + F1-F5, P4, P8, A3, A5, J6, O2, O9).

Scale notes
-----------
* The primary index is the flat table ``(word, doc, n)``: one partial + final
  hash aggregate keyed by ``(word, doc)``. A word that occurs everywhere spreads
  over as many groups as documents, so no task holds a hot word whole (H6).
* Stop words given as a list become an ``InSet`` filter inside the generated
  code (no join at all). A stop-word DataFrame goes through a left-anti join, which
  adaptive execution broadcasts if the list is small and else splits on hot words.
* ``postings`` never collects a word's whole list into one group: postings are
  cut into blocks of at most ``block_size`` documents. For integral document
  ids the block is ``doc div block_size``, an exact bound without any ranking.
  Inside a block the entries are sorted by (-n, doc).
* Blocks by rank cut the documents' order into slices: a word's list is collected per slice,
  and only the list lengths are added up over a word's slices. A hot word is as many groups
  as there are slices, and a block's documents move once more only if it spans two slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions import basename, normalize, tokenize
from ..sources.stopwords import SPANISH_STOP_WORDS
from .ordered import _written

DEFAULT_BLOCK_SIZE = 100_000
#: Documents per slice, about, of an index with blocks by rank.
SLICE_DOCS = 50_000


def crawl(df: DataFrame, name: str = "name", text: str = "text", strip_path: bool = True) -> DataFrame:
    """Crawl step: base name of each file (trimmed) and its text on one line.

    Other columns (e.g. partition columns of the folder layout) are kept.
    """
    key = basename(name) if strip_path else F.col(name)
    rest = [c for c in df.columns if c not in (name, text)]
    return df.select(key.alias(name), normalize(text).alias(text), *rest)


def tokens(df: DataFrame, doc: str = "doc", text: str = "text", unicode: bool = False,
           jvm_empties: bool = True) -> DataFrame:
    """One row per token -> ``(doc, word)`` (lower-cased, ASCII ``\\w`` by default)."""
    return df.select(F.col(doc), F.explode(tokenize(text, unicode=unicode, jvm_empties=jvm_empties)).alias("word"))


def remove_stop_words(toks: DataFrame, stop_words: Iterable[str] | DataFrame = SPANISH_STOP_WORDS,
                      word: str = "word") -> DataFrame:
    """Drop stop words (list -> in-set filter, DataFrame -> left-anti join)."""
    if isinstance(stop_words, DataFrame):
        sw = stop_words.select(F.col(stop_words.columns[0]).alias(word)).distinct()
        return toks.join(sw, word, "left_anti")
    words = list(dict.fromkeys(stop_words))
    return toks.where(~F.col(word).isin(words)) if words else toks


def term_counts(
    df: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop_words: Iterable[str] | DataFrame = SPANISH_STOP_WORDS,
    unicode: bool = False,
    block_size: int | None = None,
) -> DataFrame:
    """A3: occurrences of each word in each document -> ``(word, doc, n)``.

    ``block_size`` (integral documents) adds the ``block`` of :func:`postings` and deals the tokens by
    (word, block), so that counting and the postings need one shuffle in all. One task then has
    a word's tokens of ``block_size`` documents: for small blocks.

    When the stop words include ``""`` (the default set does) every empty token
    is dropped anyway, so the tokenizer skips its pass that drops trailing empties.
    """
    kept = _kept(df, doc, text, stop_words, unicode)
    if block_size is not None:
        kept = kept.withColumn("block", _block(doc, block_size)).repartition("word", "block")
        return kept.groupBy("word", "block", doc).agg(F.count(F.lit(1)).alias("n"))
    return kept.groupBy("word", doc).agg(F.count(F.lit(1)).alias("n"))


def _kept(df: DataFrame, doc: str, text: str, stop_words: Iterable[str] | DataFrame, unicode: bool) -> DataFrame:
    """The tokens that are no stop words."""
    if not isinstance(stop_words, DataFrame):
        stop_words = tuple(stop_words)
    empties_filtered = not isinstance(stop_words, DataFrame) and "" in stop_words
    return remove_stop_words(tokens(df, doc, text, unicode, jvm_empties=not empties_filtered), stop_words)


def term_lists(
    df: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop_words: Iterable[str] | DataFrame = SPANISH_STOP_WORDS,
    unicode: bool = False,
    slice_docs: int = SLICE_DOCS,
) -> DataFrame:
    """The counts of :func:`term_counts` as lists -> ``(word, slice, entries)``, for :func:`postings` by rank.

    ``entries`` holds ``struct(doc, n)`` in the documents' order, for the documents of one slice (about
    ``slice_docs`` of them, in that order). The tokens are dealt by (word, slice) and counted
    as runs of their sorted documents, so there is one shuffle and no group per (word, document).
    """
    kept = _kept(df, doc, text, stop_words, unicode).withColumn("slice", _slice(df, doc, slice_docs)).repartition("word", "slice")
    lists = kept.groupBy("word", "slice").agg(F.sort_array(F.collect_list(doc)).alias("docs"), F.count_if(F.col(doc).isNull()).alias("nulls"))
    places = F.when(F.size("docs") > 0, F.sequence(F.lit(0), F.size("docs") - 1)).otherwise(F.array().cast("array<int>"))
    first = lambda i: (i == 0) | (F.get("docs", i) != F.get("docs", i - 1))
    lists = lists.withColumn("runs", F.filter(places, first))
    entry = lambda i, k: F.struct(F.get("docs", i).alias("doc"), (F.coalesce(F.get("runs", k + 1), F.size("docs")) - i).cast("long").alias("n"))
    none = F.when(F.col("nulls") > 0, F.array(F.struct(F.lit(None).cast(df.schema[doc].dataType).alias("doc"), F.col("nulls").alias("n")))).otherwise(F.array())
    return lists.select("word", "slice", F.concat(none, F.transform("runs", entry)).alias("entries"))


def _block(doc: str, block_size: int) -> Column:
    # Integral division (a double quotient would round ids above 2^53).
    return F.expr(f"`{doc}` div {int(block_size)}").cast("long")


def _slice(df: DataFrame, doc: str, slice_docs: int) -> Column:
    """The slice of a document: its place among bounds that cut the documents' order into about equal parts.

    Null documents come first, as in a sort. Only the bounds, one per slice, reach the driver.
    """
    docs = df.select(F.col(doc).alias("doc")).where("doc IS NOT NULL").distinct()
    parts = -(-docs.count() // slice_docs)
    if parts <= 1:
        return F.lit(0)
    ranged = docs.repartitionByRange(parts, "doc").groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc").alias("low"))
    bounds = sorted(r["low"] for r in ranged.collect())

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(F.col(doc) < F.lit(bounds[mid]), among(lo, mid - 1)).otherwise(among(mid, hi))

    return F.when(F.col(doc).isNull(), 0).otherwise(among(0, len(bounds) - 1))


def _by_rank(lists: DataFrame, block_size: int) -> DataFrame:
    """``(word, block, _p)``, ``_p`` the block's ``struct(doc, n)``: blocks by the document's place in its word's list."""
    size = int(block_size)
    # collected from sorted rows: Spark's hash form holds 128 groups a task and then sorts twice
    conf, name = lists.sparkSession.conf, "spark.sql.execution.useObjectHashAggregateExec"
    before = conf.get(name)
    try:
        conf.set(name, "false")
        lists = _written(lists.select("word", "slice", F.col("entries").alias("_p"), F.size("entries").cast("long").alias("len")))
    finally:
        conf.set(name, before)
    ahead = lists.select(F.col("word").alias("a_word"), F.col("slice").alias("a_slice"), "len")
    # one row per slice of a word
    along, word = (Window.partitionBy("a_word").orderBy("a_slice").rowsBetween(Window.unboundedPreceding, x) for x in (-1, Window.unboundedFollowing))
    ahead = ahead.select("a_word", "a_slice", "len", F.coalesce(F.sum("len").over(along), F.lit(0)).alias("ahead"), F.sum("len").over(word).alias("all"))
    # a word of one slice has all of its blocks there
    ahead = ahead.where(F.col("all") > F.col("len")).drop("len")
    placed = lists.join(ahead, (F.col("word") == F.col("a_word")) & (F.col("slice") == F.col("a_slice")), "left")
    placed = _written(placed.select("word", "_p", "len", F.coalesce("ahead", F.lit(0)).alias("ahead"), F.coalesce("all", "len").alias("all")))

    upto = F.col("ahead") + F.col("len")
    begin, end = lambda b: F.greatest(b * size, F.col("ahead")), lambda b: F.least(b * size + size, upto)
    whole = lambda b: end(b) - begin(b) == F.least(F.lit(size), F.col("all") - b * size)
    blocks = F.sequence(F.floor(F.col("ahead") / size), F.floor((upto - 1) / size))

    def pieces(which: Callable[[Column], Column]) -> DataFrame:
        piece = lambda b: F.struct(b.alias("block"), F.slice("_p", (begin(b) - F.col("ahead") + 1).cast("int"), (end(b) - begin(b)).cast("int")).alias("_p"))
        return placed.select("word", F.explode(F.transform(F.filter(blocks, which), piece)).alias("x")).select("word", "x.block", "x._p")

    cut = pieces(lambda b: ~whole(b)).groupBy("word", "block").agg(F.flatten(F.collect_list("_p")).alias("_p"))
    return pieces(whole).unionByName(cut)


def postings(
    counts: DataFrame,
    doc: str = "doc",
    block_size: int = DEFAULT_BLOCK_SIZE,
    as_text: bool = True,
    sort: bool = False,
    by_rank: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Per word and block, the ``(doc, n)`` list sorted by (-n, doc).

    Output ``(word, block, postings)``; ``postings`` is ``"(doc,n), (doc,n)"`` text
    or, with ``as_text=False``, an array of ``struct(doc, n)``. A word with fewer
    than ``block_size`` documents (all of them, below that many documents) has
    a single block 0.

    Blocks are ranges of document numbers (strings: hash buckets). ``by_rank=True`` makes them by
    the document's place among the word's documents instead: every block but the last is full
    whatever the ids are. ``dealt=True``: the counts come from :func:`term_counts` with the same
    ``block_size`` (by rank: they are the lists of :func:`term_lists`) and are not shuffled again.

    ``sort=True`` returns the rows ordered by (word, block) (O2) with a single
    shuffle: the counts are range-partitioned on (word, block) before grouping
    (that partitioning already clusters each group, so the aggregate adds no
    exchange) and each partition is then sorted locally. A hot word's blocks
    land in different ranges; one block holds at most ``block_size`` entries.
    """
    if by_rank:
        lists = counts
        if not dealt:
            sliced = counts.withColumn("slice", _slice(counts, doc, SLICE_DOCS)).groupBy("word", "slice")
            lists = sliced.agg(F.sort_array(F.collect_list(F.struct(F.col(doc).alias("doc"), "n"))).alias("entries"))
        found = _by_rank(lists, block_size)
    elif isinstance(counts.schema[doc].dataType, IntegralType):
        # counts that were dealt by their blocks (term_counts) keep that column, hence their partitions
        blocked = counts if dealt else counts.withColumn("block", _block(doc, block_size))
    else:
        # String keys: hash buckets, as many per word as its document count needs.
        df_w = counts.groupBy("word").agg(F.count(F.lit(1)).alias("_df"))
        with_df = counts.join(df_w, "word")
        nb = F.greatest(F.lit(1), F.ceil(F.col("_df") / F.lit(block_size)))
        blocked = with_df.withColumn("block", F.pmod(F.xxhash64(F.col(doc)), nb).cast("long")).drop("_df")
    if by_rank:
        found = found.repartitionByRange("word", "block") if sort else found
        entries = F.transform("_p", lambda x: F.struct((-x["n"]).alias("neg_n"), x["doc"].alias("doc")))
        grouped = found.select("word", "block", F.sort_array(entries).alias("_p"))
    else:
        blocked = blocked.repartitionByRange("word", "block") if sort else blocked
        grouped = blocked.groupBy("word", "block").agg(
            F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg_n"), F.col(doc).alias("doc")))).alias("_p")
        )
    if as_text:
        entry = lambda x: F.concat(F.lit("("), x["doc"].cast("string"), F.lit(","), (-x["neg_n"]).cast("string"),
                                   F.lit(")"))
        body = F.array_join(F.transform("_p", entry), ", ")
    else:
        body = F.transform("_p", lambda x: F.struct(x["doc"].alias("doc"), (-x["neg_n"]).alias("n")))
    out = grouped.select("word", "block", body.alias("postings"))
    return out.sortWithinPartitions("word", "block") if sort else out
