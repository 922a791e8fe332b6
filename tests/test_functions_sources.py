"""Column functions, readers and parsers (F1-F13, S1-S12, K1) and hazards H2-H4, H7, H8, H10."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kestrel import functions as kf
from kestrel import sources
from kestrel.sources.stopwords import SPANISH_STOP_WORDS

from .conftest import rows


def test_stop_words_fixed_set():
    assert len(SPANISH_STOP_WORDS) == 165
    assert len(set(SPANISH_STOP_WORDS)) == 165
    assert {"", "'", "_", "antecabe"} <= set(SPANISH_STOP_WORDS)


def test_jvm_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\x00\t a b \r\n\x1f",)], "s string")
    assert df.select(kf.jvm_trim("s")).first()[0] == "a b"
    # Spark's own trim only strips spaces (why the JVM form exists).
    assert df.select(F.trim("s")).first()[0] != "a b"


def test_normalize_joins_lines(spark):
    df = spark.createDataFrame([(" x \n\n  y\r\n z\n",)], "s string")
    assert df.select(kf.normalize("s")).first()[0] == "x y z"


def test_basename_and_decode(spark):
    df = spark.createDataFrame([("file:/data/dir/a%20b%2Cc.txt ",), ("plain",), ("a+b",)], "p string")
    got = [r[0] for r in df.select(kf.basename(kf.decode_file_name("p"))).collect()]
    assert got == ["a b,c.txt", "plain", "a+b"]


def test_tokenize_ascii_word_chars(spark):
    # H7: \w is ASCII, accented letters split words (fixture row 3).
    df = spark.createDataFrame([("también don't",)], "s string")
    toks = [t for t in df.select(kf.tokenize("s")).first()[0] if t]
    assert toks == ["tambi", "n", "don't"]
    uni = [t for t in df.select(kf.tokenize("s", unicode=True)).first()[0] if t]
    assert uni == ["también", "don't"]


def test_split_words_drops_trailing_empties(spark):
    # H3: "Need a hug " gives 3 tokens on the JVM; inner empties stay.
    df = spark.createDataFrame([("Need a hug ",), ("a  b",), ("",), ("   ",)], "s string")
    got = [r[0] for r in df.select(kf.split_words("s")).collect()]
    assert got == [["Need", "a", "hug"], ["a", "", "b"], [""], []]


def test_route_text_and_join_fields(spark):
    df = spark.createDataFrame([("SEA", "PDX", 2, None)], "a string, b string, n long, x string")
    assert df.select(kf.route_text("a", "b", "n")).first()[0] == "SEA -> PDX: 2"
    assert df.select(kf.join_fields(["a", "x", "n"])).first()[0] == "SEA|null|2"


def test_date_parts_zero_padded(spark):
    df = spark.createDataFrame([("2008-01-05 10:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert tuple(df.select(*kf.date_parts("t")).first()) == ("2008", "01", "05")


def test_empty_as_strict_lenient(spark):
    # H4 / fixture row 6: "" -> 0.0 with empty_as, null when lenient, error when strict.
    df = spark.createDataFrame([("",), ("2.5",)], "v string")
    assert [r[0] for r in df.select(kf.empty_as("v", "double", 0.0)).collect()] == [0.0, 2.5]
    assert [r[0] for r in df.select(kf.to_type("v", "double")).collect()] == [None, 2.5]
    with pytest.raises(Exception):
        df.select(kf.to_type("v", "double", strict=True)).collect()


def test_parse_delimited_header_and_positions(spark):
    lines = spark.createDataFrame([("id, name ,n",), ("1, a ,7",), ("2,b",), (" id ,x,y",)], "value string")
    out = sources.parse_delimited(lines, "id long, name string, n int", header_token="id", status_col="ok")
    assert rows(out) == [(1, "a", 7, True), (2, "b", None, False)]
    first = sources.parse_delimited(lines, "id string, name string, n string", header_token="first")
    assert rows(first, "id") == [("1",), ("2",)]


def test_parse_delimited_strict_short_record_fails(spark):
    lines = spark.createDataFrame([("1,2",)], "value string")
    with pytest.raises(Exception):
        sources.parse_delimited(lines, "a int, b int, c int", strict=True).collect()


def test_parse_ratings_and_movies(spark):
    r = spark.createDataFrame([("1::10::4.5::978300760",)], "value string")
    assert rows(sources.parse_ratings(r)) == [(1, 10, 4.5)]
    # H2 / fixture row 9: genres split on a literal pipe.
    m = spark.createDataFrame([("7::Some Film::Drama|War",)], "value string")
    assert rows(sources.parse_movies(m)) == [(7, "Some Film", ["Drama", "War"])]


def test_parse_vectors_skips_blank_lines(spark):
    df = spark.createDataFrame([("0.0 0.1 0.2",), ("",), ("9.0 9.1 9.2",)], "value string")
    out = sources.parse_vectors(df)
    assert [list(r.features) for r in out.collect()] == [[0.0, 0.1, 0.2], [9.0, 9.1, 9.2]]


def test_parse_pairs_good_and_bad(spark):
    # H8 / fixture row 2.
    df = spark.createDataFrame([("(d1.txt,Hola, MUNDO)",), ("broken",)], "value string")
    assert rows(sources.parse_pairs(df)) == [("", "", False), ("d1.txt", "hola, mundo", True)]


def test_read_documents_whole_files(spark, tmp_dir):
    # Fixture row 1: the name keeps spaces and commas, the text lands on one line.
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "a b,c.txt"), "w") as fh:
        fh.write(" x \n\n  y\r\n z\n")
    with open(os.path.join(d, "two.txt"), "w") as fh:
        fh.write("one\ntwo")
    from kestrel.operators import text as tx

    out = tx.crawl(sources.read_documents(spark, d + "/*"))
    assert rows(out) == [("a b,c.txt", "x y z"), ("two.txt", "one two")]


def test_write_text_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("d1", "hello world")], "name string, text string")
    path = os.path.join(tmp_dir, "crawl")
    sources.write(sources.format_pairs(df), path, fmt="text")
    sources.write(sources.format_pairs(df), path, fmt="text")  # overwrite, not append
    back = sources.parse_pairs(sources.read_lines(spark, path))
    assert rows(back) == [("d1", "hello world", True)]


def test_read_csv_readers(spark, tmp_dir):
    p = os.path.join(tmp_dir, "films.csv")
    with open(p, "w") as fh:
        fh.write("year,title,IMDB\n2008,A,10\n2008,B,9.1\n")
    df = sources.read_csv_strings(spark, p)
    assert df.dtypes == [("year", "string"), ("title", "string"), ("IMDB", "string")]
    t = os.path.join(tmp_dir, "tweets.csv")
    with open(t, "w") as fh:
        fh.write('4,1,"Sat May 16",q,u,"A bright warm day"\n')
    tw = sources.read_csv(spark, t, schema="polarity int, id long, date string, query string, user string, tweet string")
    assert tw.first()["tweet"] == "A bright warm day"
    inferred = sources.read_csv(spark, t, infer=True, names=["polarity", "id", "date", "query", "user", "tweet"])
    assert inferred.columns[0] == "polarity"


def test_text_functions_are_linear_in_runs_of_blanks(spark):
    import time

    from kestrel.functions import normalize, split_whitespace, split_words, tokenize
    from kestrel.sources import parse_pairs

    n = 1_000_000
    blanks = F.concat(F.lit("a"), F.repeat(F.lit(" "), n), F.lit("b"), F.repeat(F.lit(" "), n))
    df = spark.range(1).select(blanks.alias("t"))
    began = time.time()
    got = df.select(
        F.length(normalize("t")), F.size(split_words("t")), F.size(split_whitespace("t")), F.size(tokenize("t")), F.size(tokenize(F.concat("t", F.repeat(F.lit(","), n))))
    ).first()
    assert tuple(got) == (n + 2, n + 1, 2, n + 1, n + 1)
    lines = spark.range(1).select(F.concat(F.repeat(F.lit(" \n\t"), n), F.lit("x"), F.repeat(F.lit(" \n"), n), F.lit("y")).alias("t"))
    assert lines.select(normalize("t").alias("n")).first()["n"] == "x y"
    pairs = spark.range(1).select(F.concat(F.lit("(n,"), F.repeat(F.lit(") "), n), F.lit("x)"), F.repeat(F.lit(" "), n)).alias("value"))
    assert parse_pairs(pairs).first()["ok"]
    assert time.time() - began < 60


def test_jvm_split_corner_cases(spark):
    from kestrel.functions import split_words, tokenize

    cases = {"": [""], " ": [], "   ": [], "a": ["a"], "a ": ["a"], " a": ["", "a"], "a  b  ": ["a", "", "b"], "  a": ["", "", "a"]}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.w for r in df.select("t", split_words("t").alias("w")).collect()} == cases
    assert df.sparkSession.range(1).select(split_words(F.lit("a::b::::"), "::").alias("w")).first().w == ["a", "b"]
    toks = {"": [""], "...": [], "a.b..": ["a", "b"], ".a": ["", "a"]}
    df = spark.createDataFrame([(k,) for k in toks], "t string")
    assert {r.t: r.w for r in df.select("t", tokenize("t").alias("w")).collect()} == toks


def test_pairs_keep_any_character(spark):
    from kestrel.sources import format_pairs, parse_pairs

    texts = ["a\rb", "a\u2028b", "x) (y", ""]
    df = spark.createDataFrame([("n", t) for t in texts], "name string, text string")
    got = parse_pairs(format_pairs(df))
    assert rows(got) == [("n", t, True) for t in texts]


def test_vectors_trailing_blanks_and_bad_numbers(spark):
    from kestrel.sources import parse_vectors

    df = spark.createDataFrame([("1.0 2.0 ",), ("3.0 x",), ("",), ("4 5",), ("  ",)], "value string")
    got = [None if r.features is None else r.features.toArray().tolist() for r in parse_vectors(df, strict=False).collect()]
    assert got == [[1.0, 2.0], None, [4.0, 5.0], None]
    assert parse_vectors(df.where("value like '1%'")).first().features.toArray().tolist() == [1.0, 2.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_vectors(df.where("value like '3%'")).collect()


def test_padded_header_is_dropped(spark):
    from kestrel.sources import parse_delimited

    df = spark.createDataFrame([(" Year,Month",), ("2008,1",), ("Year ,Month",)], "value string").coalesce(1)
    assert rows(parse_delimited(df, "y string, m string", header_token="first")) == [("2008", "1")]


def test_csv_exact_round_trip(spark, tmp_dir):
    from kestrel.sources import CSV_EXACT, read_csv, write

    texts = ['a"b', "a\nb", "a\r\nb", " x ", "", None, "null", "\\", "a,b", "\\N", '""', "#c"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    write(df, f"{tmp_dir}/c", fmt="csv", **CSV_EXACT)
    assert rows(read_csv(spark, f"{tmp_dir}/c", "i int, t string", **CSV_EXACT)) == list(enumerate(texts))


def test_csv_records_split_and_every_text_comes_back(spark, tmp_dir):
    from kestrel.sources import read_csv_records, write_csv_records

    texts = ['a\n"b",|\r\n', "", " ", "\x1e", "\x1f", "\x1fe\x1ff\x1e\x1f", None, "null", "é x", '"', "x" * 3000 + "\n" * 50]
    df = spark.createDataFrame([(i, t, "p%d" % (i % 2)) for i, t in enumerate(texts * 40)], "id long, t string, p string")
    write_csv_records(df.coalesce(1), f"{tmp_dir}/c")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        back = read_csv_records(spark, f"{tmp_dir}/c", "id long, t string, p string")
        assert back.rdd.getNumPartitions() > 3  # one file, many tasks
        assert rows(back) == rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    write_csv_records(df, f"{tmp_dir}/d", partition_by="p")
    assert rows(read_csv_records(spark, f"{tmp_dir}/d", "id long, t string, p string")) == rows(df)


def test_crawl_files_opens_each_file_once_from_all_cores(spark, tmp_dir, monkeypatch):
    from kestrel.plans import text_queries

    read, lines = [], []
    real_read, real_write = text_queries.read_documents, text_queries.write

    def write(df, path, **options):
        lines.append((options, df.rdd.getNumPartitions()))
        real_write(df, path, **options)

    monkeypatch.setattr(text_queries, "write", write)
    monkeypatch.setattr(text_queries, "read_documents", lambda s, path: read.append(path) or real_read(s, path))
    data = [(i, f"  line {i}\n\n  next") for i in range(40)] + [(40, None), (41, "")]
    spark.createDataFrame(data, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    out = text_queries.crawl_files(spark, tmp_dir)
    assert lines[0][0]["fmt"] == "text" and lines[0][1] >= 8  # a table in one piece is dealt out
    assert read[0] not in {f.rsplit("/", 1)[0].removeprefix("file://") for f in out.inputFiles()}  # the result reads the written crawl
    got = {r.doc_id: (r.text, r.n_of_name) for r in out.collect()}
    assert got[3] == ("line 3 next", 1) and len(got) == 42


def test_crawl_files_reads_folders_in_bounded_batches(spark, tmp_dir, monkeypatch):
    from kestrel.plans import text_queries

    found = []
    real_read = text_queries.read_documents

    def read(s, path):
        folder = path.removeprefix("file://").removesuffix("/*")
        found.append({d: sorted(names) for d, _, names in os.walk(folder) if d != folder})
        return real_read(s, path)

    monkeypatch.setattr(text_queries, "read_documents", read)
    monkeypatch.setattr(text_queries, "FILES_PER_READ", 100)
    monkeypatch.setattr(text_queries, "FILES_PER_FOLDER", 20)
    data = [(i // 2, f"  line {i}\r\n\n  next") for i in range(480)] + [(7, None), (8, ""), (9, "\n"), (9, "é\x00\n\n b")]  # ids repeat
    spark.createDataFrame(data, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = text_queries.crawl_files(spark, tmp_dir)
    expected = [(i // 2, f"line {i} next", 1) for i in range(480)] + [(7, "", 1), (8, "", 1), (9, "", 1), (9, "é\x00 b", 1)]
    assert rows(got, "doc_id", "text", "n_of_name") == expected
    sizes = [sum(map(len, folders.values())) for folders in found]
    assert len(sizes) == 5 and sum(sizes) == len(data) and max(sizes) < 200  # a scan's list stays small
    assert max(len(names) for folders in found for names in folders.values()) < 60
    names = [n for folders in found for in_folder in folders.values() for n in in_folder]
    assert len(set(names)) == len(data) and all(n.endswith(".txt") for n in names)  # no checksum or unfinished files


def test_crawl_files_of_no_documents(spark, tmp_dir):
    from kestrel.plans import text_queries

    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert text_queries.crawl_files(spark, tmp_dir).collect() == []


@pytest.mark.parametrize("mounted", [True, False])
def test_write_names_a_file_per_row(spark, tmp_dir, monkeypatch, mounted):
    if not mounted:  # a store that only Spark's writer reaches
        monkeypatch.setattr(sources.files, "_new_folder", lambda s, path: None)
    path = f"{tmp_dir}/each"
    texts = ["a\nb", "", None, "é\r", "x" * 100_000]
    df = spark.createDataFrame([(i % 2, f"n {i}.txt", t) for i, t in enumerate(texts)], "part int, name string, text string")
    sources.write(df.limit(1), path, fmt="text", partition_by="part", file_names="name")
    sources.write(df.repartition(3), path, fmt="text", partition_by="part", file_names="name")  # overwrite, not append
    back = sources.read_documents(spark, path)
    assert rows(back, "part", "text") == [(i % 2, (t or "") + "\n") for i, t in enumerate(texts)]
    if mounted:
        assert rows(back, "name") == [(f"n {i}.txt",) for i in range(5)]
        sources.write(df.drop("part"), path, fmt="text", file_names="name")  # in one folder
        assert sorted(os.listdir(path)) == [f"n {i}.txt" for i in range(5)]
    with pytest.raises(ValueError, match="one text column"):
        sources.write(df, path, fmt="text", file_names="name")
    with pytest.raises(ValueError, match="fmt='text'"):
        sources.write(df, path, partition_by="part", file_names="name")
