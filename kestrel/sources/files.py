"""File readers and the overwriting writer.

Readers return plain DataFrames with explicit schemas where the layout is known,
so no inference pass is spent; the parsers in :mod:`kestrel.sources.parsers`
turn text lines into typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from ..functions import decode_file_name, jvm_trim


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file -> ``(name, text)``; ``name`` is the decoded base name.

    ``wholetext`` keeps each file in one row, like ``wholeTextFiles``. The file name
    comes from the hidden ``_metadata`` column (URL-encoded, see H10). Partition
    columns found in the folder layout (``key=value`` directories) are kept.
    """
    raw = spark.read.text(path, wholetext=True)
    return raw.select(
        jvm_trim(decode_file_name(F.col("_metadata.file_name"))).alias("name"),
        F.col("value").alias("text"),
        *[c for c in raw.columns if c != "value"],
    )


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """One row per line -> ``(value)``.

    Lines end at ``\\n``, ``\\r`` or ``\\r\\n``; with ``line_sep`` only there (texts that may
    hold a lone carriage return).
    """
    return spark.read.text(path, lineSep=line_sep)


#: CSV settings under which every text comes back as it was: quotes doubled, line breaks inside
#: quotes, blanks kept. Null is the control character U+0001, which no text consists of.
CSV_EXACT = {
    "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\x01",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv_strings(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """S3: CSV with a header row, every column a string (no inference).

    When ``names`` are given they form the schema, so Spark reads no sample.
    """
    reader = spark.read.option("header", "true")
    if names:
        reader = reader.schema(StructType([StructField(n, StringType()) for n in names]))
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = False,
    names: list[str] | None = None,
    infer: bool = False,
    **options,
) -> DataFrame:
    """CSV with an explicit schema (preferred) or inferred types, renamed by position.

    ``options`` go to Spark's reader; ``**CSV_EXACT`` reads free text with quotes and line
    breaks (such files are read one task per file).
    """
    reader = spark.read.option("header", str(header).lower()).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer).lower())
    df = reader.csv(path)
    return df.toDF(*names) if names else df


#: CSV settings of files whose records end with U+001E and hold that character nowhere else: line
#: breaks in texts are plain characters, so Spark splits such files over tasks (``multiLine`` cannot).
CSV_RECORDS = {**CSV_EXACT, "multiLine": "false", "lineSep": "\x1e"}
_ESCAPE, _END = "\x1f", "\x1e"


def write_csv_records(df: DataFrame, path: str, partition_by: list[str] | str | None = None) -> None:
    """K1: free text as CSV that can be split: records end with U+001E.

    A U+001E inside a text is written as U+001F "e" and a U+001F as U+001F "f", which
    :func:`read_csv_records` takes back.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])

    def safe(name: str):
        return F.replace(F.replace(F.col(f"`{name}`"), F.lit(_ESCAPE), F.lit(_ESCAPE + "f")), F.lit(_END), F.lit(_ESCAPE + "e"))

    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in parts]
    write(df.withColumns({c: safe(c) for c in texts}), path, fmt="csv", partition_by=parts, **CSV_RECORDS)


def read_csv_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Files of :func:`write_csv_records`, split over tasks, every text as it was."""
    df = spark.read.schema(schema).options(**CSV_RECORDS).csv(path)

    def plain(name: str):
        return F.replace(F.replace(F.col(f"`{name}`"), F.lit(_ESCAPE + "e"), F.lit(_END)), F.lit(_ESCAPE + "f"), F.lit(_ESCAPE))

    return df.withColumns({f.name: plain(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)})


def format_pairs(df: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """The crawl's text format: one ``(name,text)`` line per row -> ``(value)``."""
    return df.select(F.concat(F.lit("("), F.col(name).cast("string"), F.lit(","), F.col(text), F.lit(")")).alias("value"))


def write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | str | None = None,
          file_names: str | None = None, **options) -> None:
    """K1: replace whatever is at ``path`` with ``df`` (optionally in ``key=value`` folders).

    ``fmt="text"`` needs a single string column besides the partition columns
    (use :func:`format_pairs`). With ``file_names``, a column of plain names that occur once, every
    row becomes a text file of its own (partition columns must be whole numbers then).
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if file_names is not None:
        if fmt != "text" or options:
            raise ValueError("file_names goes with fmt='text' and no options")
        _write_each(df, path, file_names, parts)
        return
    writer = df.write.mode("overwrite").format(fmt).options(**options)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)


def _write_each(df: DataFrame, path: str, names: str, parts: list[str]) -> None:
    """A text file per row, written by the tasks.

    Hadoop's local file system starts a process whenever it sets a permission on a file; in a
    mounted folder the tasks therefore open the files themselves. A file appears under its
    name when it is whole, and a repeated task replaces its files with the same ones.
    Other stores get Spark's writer, whose tasks move their own files; it picks the names.
    """
    texts = df.drop(names)
    text = [c for c in texts.columns if c not in parts]
    if len(text) != 1 or not all(isinstance(df.schema[c].dataType, IntegralType) for c in parts):
        raise ValueError(f"one text column and whole numbers as folders, not {texts.schema.simpleString()}")
    mounted = _new_folder(df.sparkSession, path)
    if mounted is None:
        each = {"maxRecordsPerFile": "1", "mapreduce.fileoutputcommitter.algorithm.version": "2"}
        write(texts, path, fmt="text", partition_by=parts, **each)
        return

    def save(batches):  # nested: tasks need no copy of this module
        import os
        import uuid

        hidden, made = f".{uuid.uuid4().hex}", set()  # readers skip names with a dot first
        for batch in batches:
            for folder, name, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                place = f"{mounted}/{folder.as_py()}"
                if place not in made:
                    os.makedirs(place, exist_ok=True)
                    made.add(place)
                with open(f"{place}/{hidden}", "wb") as file:
                    file.write(text.as_py() or b"")
                    file.write(b"\n")
                os.replace(f"{place}/{hidden}", f"{place}/{name.as_py()}")  # between folders, renames wait for each other
        yield from ()

    values = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in parts]
    rows = df.select(F.concat_ws("/", *values), F.col(names).cast("string"), F.col(text[0]).cast("binary"))
    rows.mapInArrow(save, "saved long").write.format("noop").mode("overwrite").save()


def _new_folder(spark: SparkSession, path: str) -> str | None:
    """Makes ``path`` an empty folder; its local path if it is mounted (the same on every machine), else None."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(folder, True)
    fs.mkdirs(folder)
    uri = fs.resolvePath(folder).toUri()
    return uri.getPath().rstrip("/") if uri.getScheme() == "file" else None
