"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import scratch_path

#: A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Bytes of text that a Python worker turns into objects at a time.
BLOCK = 4 << 20


def staged(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared work folder and read it back.

    The copy cuts the lineage: every later read sees the same rows, also after an
    executor is lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished queries now.

    Its cleaner acts when the driver collects garbage, which may be long after a result was
    written, while the executors' disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ref(name: str) -> Column:
    """The column called ``name``, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null gives empty bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    else:
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def blocks(texts: Sequence[bytes], size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes each; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > size:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def spans(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """``blocks`` of a string column, from its lengths alone."""
    start = total = 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        if i > start and total + (n or 0) > size:
            yield start, i
            start, total = i, 0
        total += n or 0
    if start < len(column):
        yield start, len(column)


def split_words(texts: Sequence[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words in order, and each text's number of words."""
    words = [t.split() for t in texts]
    return list(itertools.chain.from_iterable(words)), np.fromiter(map(len, words), np.int64, len(words))


def starts(lengths: np.ndarray) -> np.ndarray:
    """Start of each run in the concatenation, and the total as the last entry."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths, dtype=np.int64)])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds; empty ranges give 0."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing function (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
