"""Benchmark decontamination by size-partitioned MinHash containment search. DataFrame functions only.

An item is contained in a document if at least ``threshold`` of the item's distinct
word shingles occur in the document.

1. Items are partitioned by size (number of distinct shingles, powers of two). An item's
   sketch is its bottom-k MinHash: the *k* smallest shingle hashes. A contained item misses
   at most ``n - ceil(threshold * n)`` shingles, so with ``k`` that many plus ``hits``, taken
   from the partition's upper size bound, at least ``hits`` sketch hashes occur in the
   document: the search loses no contained item, however long the document is.
2. A document is matched against the sketches of the partitions that its own size can
   contain; pairs with too few hits are dropped.
3. The remaining pairs are verified: exact containment of the shingles themselves.

Words are lower-cased runs of letters and digits. Defined results: null and empty texts and
items, and items with fewer words than a shingle, match nothing; repeated items each match;
repeated documents (equal id and text) give one row per item; documents with equal ids and
different texts are kept apart by ``text_hash``; empty tables give an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, ref, staged

SHINGLE, THRESHOLD, HITS = 5, 0.8, 2
#: Sketch and item tables are broadcast only up to this many rows; larger ones are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _per_text(text: Column, shingle: int, one) -> Column:
    """``one`` applied to every window of ``shingle`` words; the words are computed once per row."""

    def windows(w: Column) -> Column:
        last = F.size(w) - shingle
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: one([F.get(w, i + j) for j in range(shingle)])))

    return F.get(F.transform(F.array(words(text)), windows), 0)


def shingles(text: Column, shingle: int = SHINGLE) -> Column:
    """All shingles as strings, in order; null where there is none."""
    return _per_text(text, shingle, lambda w: F.concat_ws(" ", *w))


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """64-bit hashes of all shingles, in order; null where there is none."""
    return _per_text(text, shingle, lambda w: F.xxhash64(*w))


def _bounded(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it is small enough by count."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _needed(n: Column, threshold: float) -> Column:
    return F.ceil(n * threshold - 1e-9).cast("int")


def sketches(items: DataFrame, item_id: str, text_col: str, shingle: int = SHINGLE, threshold: float = THRESHOLD, hits: int = HITS) -> DataFrame:
    """One row per sketch hash: item, size partition, smallest possible document size, hits to reach, hash."""
    hashes = F.array_distinct(shingle_hashes(ref(text_col), shingle))
    sized = items.select(ref(item_id).alias("item"), hashes.alias("h")).where(F.size("h") > 0).withColumn("n", F.size("h"))
    part = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sized = sized.withColumn("part", part)
    lower = F.pow(F.lit(2.0), F.col("part")).cast("int")  # sizes lower .. 2 * lower - 1
    upper = lower * 2 - 1
    reach = F.least(F.lit(hits), _needed(F.col("n"), threshold))
    depth = upper - _needed(upper, threshold) + reach
    sized = sized.withColumn("reach", reach).withColumn("least_size", _needed(lower, threshold))
    return sized.select("item", "part", "least_size", "reach", F.explode(F.slice(F.array_sort("h"), F.lit(1), depth)).alias("hash"))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    hits: int = HITS,
) -> DataFrame:
    """(id, text_hash, item, n_matched, n_shingles, containment) for every item contained in a document."""
    sketch = _bounded(staged(sketches(items, item_id, item_text, shingle, threshold, hits), "sketches"))
    lean = docs.select(ref(id_col).alias("id"), F.xxhash64(ref(text_col)).alias("text_hash"), ref(text_col).alias("text"))
    probes = lean.select("id", "text_hash", shingle_hashes(F.col("text"), shingle).alias("h"))
    probes = probes.select("id", "text_hash", F.size("h").alias("size"), F.explode("h").alias("hash"))
    found = probes.join(sketch, "hash").where(F.col("size") >= F.col("least_size"))
    found = found.groupBy("id", "text_hash", "item", "reach").agg(F.count_distinct("hash").alias("n"))
    pairs = staged(found.where(F.col("n") >= F.col("reach")).select("id", "text_hash", "item"), "candidates")

    # exact shingles of the candidate pairs alone
    parts = items.select(ref(item_id).alias("item"), F.array_distinct(shingles(ref(item_text), shingle)).alias("s"))
    parts = _bounded(staged(parts.select("item", F.size("s").alias("n_shingles"), F.explode("s").alias("shingle")).distinct(), "items"))
    ids = pairs.select(F.col("id").alias("c_id"), F.col("text_hash").alias("c_hash")).distinct()
    texts = lean.join(ids, F.col("id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left_semi")
    own = texts.select("id", "text_hash", F.explode(F.array_distinct(shingles(F.col("text"), shingle))).alias("shingle"))
    matched = own.join(parts, "shingle").groupBy("id", "text_hash", "item", "n_shingles").agg(F.count_distinct("shingle").alias("n_matched"))
    wanted = pairs.select(F.col("id").alias("c_id"), F.col("text_hash").alias("c_hash"), F.col("item").alias("c_item"))
    same = F.col("id").eqNullSafe(F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")) & F.col("item").eqNullSafe(F.col("c_item"))
    checked = matched.join(wanted, same, "left_semi").where(F.col("n_matched") >= _needed(F.col("n_shingles"), threshold))
    return checked.select("id", "text_hash", "item", F.col("n_matched").cast("long"), F.col("n_shingles").cast("long"), (F.col("n_matched") / F.col("n_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    digest, bad_id, bad_key = fresh(docs, "dec_hash", "dec_id", "dec_key")
    found = contained_items(docs, items, id_col, text_col, **options).select("id", "text_hash").distinct()
    found = staged(found, "contaminated").toDF(bad_id, bad_key)
    same = ref(id_col).eqNullSafe(ref(bad_id)) & (ref(digest) == ref(bad_key))
    return docs.withColumn(digest, F.xxhash64(ref(text_col))).join(found, same, "left_anti").drop(digest)
