"""SimHash near-duplicates by a byte-position inverted index with count filtering.

1. A text's fingerprint has bit *i* set if more than half of its shingles' XXH64
   hashes (seed 42) have it set.
2. Two 64-bit fingerprints at most *k* bits apart share at least ``8 - k`` of their 8
   bytes at the same positions. The inverted index therefore lists every distinct
   fingerprint under each choice of ``8 - k`` positional bytes: a pair that reaches
   the guaranteed count meets in at least one list, and others rarely meet. A list
   holds at most ``256 ** k`` fingerprints, whatever the data.
3. Inside a list the shared positional bytes of each candidate pair are tallied, pairs
   below the minimum are dropped and the rest verified by their bit distance. Long
   lists are probed by bit pattern, not pair by pair; a list gives a spanning forest of
   its links, never all pairs.
4. Components of the links, each named by its smallest document id.

Copies share one fingerprint and are grouped before the index is built.

Defined results: a null or empty text has fingerprint 0 and links like any other; null
ids are kept, a component's id ignores them (null if it has no other); repeated rows each
get a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK, as_bytes, blocks, fresh, ref, spans, staged, starts
from .components import components

SEED = 42
#: Lists up to this length are compared by shifting, longer ones by probing.
SHORT = 24


def fingerprints(texts: list[bytes], shingle: int = 3, seed: int = SEED) -> np.ndarray:
    """64-bit fingerprints of whole texts: A-Z lower-cased, words joined by one blank, all shingles counted."""
    out, digest = [np.zeros(0, np.uint64)], xxhash.xxh64_intdigest
    for lo, hi in blocks(texts, 1 << 20):
        hashes, lengths = [], []
        for text in texts[lo:hi]:
            words = text.lower().split()
            parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)] * bool(words)
            found = [digest(x, seed) for x in parts]
            hashes += found
            lengths.append(len(found))
        n = np.array(lengths, np.int64)
        some = np.flatnonzero(n)
        result = np.zeros(len(n), np.uint64)
        if len(some):
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, starts(n)[:-1][some], axis=0, dtype=np.int64)
            result[some] = np.packbits(2 * ones > n[some, None], axis=1, bitorder="little").view("<u8").ravel()
        out.append(result)
    return np.concatenate(out)


def with_fingerprint(df: DataFrame, text_col: str, out: str, keep: list[str], shingle: int = 3, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` of ``df`` and the text's fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in spans(batch.column(batch.num_columns - 1), BLOCK):
                part = batch.slice(lo, hi - lo)
                found = fingerprints(as_bytes(part.columns[-1]), shingle, seed)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found.view(np.int64))], names=[*keep, out])

    kept = df.select(*[ref(c) for c in keep])
    rows = df.select(*[ref(c) for c in keep], ref(text_col).alias(fresh(df, "sim_text")[0]))
    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.LongType())]))


def position_masks(max_distance: int) -> list[int]:
    """One 64-bit mask for each choice of ``8 - max_distance`` byte positions."""
    return [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(8), 8 - max_distance)]


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the 8 positional bytes of two fingerprints agree, from their exclusive or."""
    return (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _list_links(key: np.ndarray, fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside the lists of equal ``key`` (sorted by key, then fp), as stars."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    length = np.diff(edge)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        x = fp[i] ^ fp[j]
        counted = shared_bytes(x) >= 8 - max_distance
        close = counted & (np.bitwise_count(x) <= max_distance)
        left.append(i[close])
        right.append(j[close])

    short = np.repeat((length > 1) & (length <= SHORT), length)
    for d in range(1, int(min(SHORT, length.max(initial=0)))):
        i = np.flatnonzero(short[:-d] & (key[d:] == key[:-d]))
        if len(i) == 0:
            break
        keep(i, i + d)
    for r in np.flatnonzero(length > SHORT):
        at, end = edge[r], edge[r + 1]
        own = fp[at:end]
        vary = int(np.bitwise_or.reduce(own ^ own[0]))
        bits = [b for b in range(64) if vary >> b & 1]
        for k in range(1, max_distance + 1):
            for flip in combinations(bits, k):
                other = own ^ np.uint64(sum(1 << b for b in flip))
                found = np.minimum(np.searchsorted(own, other), len(own) - 1)
                hit = np.flatnonzero((own[found] == other) & (found > np.arange(len(own))))
                keep(at + hit, at + found[hit])
    a, b = np.concatenate(left), np.concatenate(right)
    # the forest: every member hangs under the smallest member it reaches inside these lists
    label = np.arange(len(fp))
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.flatnonzero(label != np.arange(len(fp)))
    return fp[label[member]], fp[member]


def links(distinct: DataFrame, fp_col: str, max_distance: int) -> DataFrame:
    """(a, b): links between distinct fingerprints at most ``max_distance`` bits apart, enough of them to join all that belong together."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance must be 0 to 3: beyond that a list of positional bytes has no useful bound")
    masks = position_masks(max_distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = _list_links(key, fp, max_distance)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        key, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last list may go on
            if cut > 1 << 16:
                yield found(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
        if len(key):
            yield found(key, fp)

    fp = ref(fp_col)
    index = F.explode(F.array(*[F.struct(F.lit(i).alias("set"), fp.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("bytes")) for i, m in enumerate(masks)]))
    lists = distinct.select(index.alias("list"), fp.alias("fp")).select(F.xxhash64("list.set", "list.bytes").alias("key"), "fp")
    # order by the unsigned value, as numpy compares it
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return lists.repartition("key").sortWithinPartitions("key", unsigned).mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """One row per input row: id, columns ``keep``, ``fingerprint`` (long) and ``component_id``."""
    rows = _rooted(df, id_col, text_col, shingle, max_distance, seed, keep)
    return rows.select(*[ref(c) for c in rows.columns[:-1]])


def _rooted(df: DataFrame, id_col: str, text_col: str, shingle: int = 3, max_distance: int = 2, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """``near_duplicates`` and, as last column, the component's smallest fingerprint: it tells components apart whose smallest ids are equal or null."""
    keep = [c for c in keep or [] if c != id_col]
    prints = staged(with_fingerprint(df, text_col, "fingerprint", [id_col, *keep], shingle, seed), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min(ref(id_col)).alias("first"))
    found = components(links(distinct.select("fingerprint"), "fingerprint", max_distance))
    rooted = distinct.join(found, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    rooted = staged(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    root = fresh(prints, "sim_root")[0]
    # one row per distinct fingerprint on the right; a hot fingerprint on the left is split by the skew join
    return prints.join(rooted.join(named, "root").select("fingerprint", "component_id", F.col("root").alias(root)), "fingerprint", "left").select(
        ref(id_col), *[ref(c) for c in keep], "fingerprint", "component_id", root
    )


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` less near-duplicates: of each component the row with the smallest id stays.

    Ties: the smallest text hash; rows equal in id and text are one document, of which the row with the
    smallest hash of all columns stays, so reruns agree.
    """
    digest, sim_id, sim_key = fresh(df, "sim_digest", "sim_id", "sim_key")
    hashed = df.select(ref(id_col), F.xxhash64(ref(text_col)).alias(digest), ref(text_col))
    rows = _rooted(hashed, id_col, text_col, keep=[digest], **options)
    rows = rows.groupBy(F.col(rows.columns[-1]).alias("root"), ref(id_col).alias("sim_id"), F.col(digest).alias("sim_key")).agg(F.count("*").alias("n"))
    first = F.min_by(F.struct("sim_id", "sim_key", "n"), F.struct(F.col("sim_id").isNull(), "sim_id", "sim_key")).alias("k")
    kept = staged(rows.groupBy("root").agg(first).select("k.*"), "kept").toDF(sim_id, sim_key, "n")
    docs = df.withColumn(digest, F.xxhash64(ref(text_col)))
    same = ref(id_col).eqNullSafe(ref(sim_id)) & (ref(digest) == ref(sim_key))
    single = docs.join(kept.where("n = 1").drop("n"), same, "left_semi")
    (whole,) = fresh(docs, "sim_row")
    repeated = docs.join(kept.where("n > 1").drop("n"), same, "left_semi").groupBy(ref(id_col).alias(sim_id), ref(digest).alias(sim_key))
    row = F.struct(*[ref(c) for c in docs.columns])
    repeated = repeated.agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias(whole)).select(f"{whole}.*")
    return single.unionByName(repeated).drop(digest)
