"""Relational, inverted index and graph operators (J1, J2, A1, A12, O1, A3, A5, G1-G8) and H5, H6, H11."""

from __future__ import annotations

import re

import pytest

from pyspark.sql import functions as F

from kestrel.operators import graph as g
from kestrel.operators import relational as rel
from kestrel.operators import text as tx

from .conftest import plan_text, rows


def test_enrich_fan_out_nulls_and_count_join(spark):
    # Fixture row 5.
    left = spark.createDataFrame([("2008", "A"), ("2008", "B"), (None, "C")], "yearOfMovie string, movie string")
    right = spark.createDataFrame([("2008", "A", "10"), ("2008", "A", "9.1")], "year string, title string, IMDB string")
    joined = rel.enrich(left, right, [("yearOfMovie", "year"), ("movie", "title")])
    assert rows(joined) == [("2008", "A", "10"), ("2008", "A", "9.1"), ("2008", "B", None), (None, "C", None)]
    counts = rel.group_count(left, "yearOfMovie", "numMoviesPerYear")
    assert rows(counts) == [("2008", 2), (None, 1)]
    out = rel.with_group_count(joined, counts, "yearOfMovie")
    assert rows(out, "movie") == [("A",), ("A",), ("B",)]  # C lost: null key
    ordered = [r["IMDB"] for r in rel.sort(out, "yearOfMovie", "IMDB").collect()]
    assert ordered == [None, "10", "9.1"]  # H5: string order, nulls first


def test_group_max_string_vs_cast(spark):
    df = spark.createDataFrame([("2008", "10"), ("2008", "9.1")], "y string, v string")
    assert rows(rel.group_max(df, "y", "v", name="m")) == [("2008", "9.1")]
    assert rows(rel.group_max(df, "y", "v", cast="double", name="m")) == [("2008", 10.0)]


def test_group_counts_see_files_added_later(spark, tmp_dir):
    # Nothing is cached: the same call on the same folder reads what is there now.
    path = f"{tmp_dir}/t"

    def run():
        df = spark.read.parquet(path)
        return rows(rel.with_group_count(df, rel.group_count(df, "k", "n"), "k"))

    spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int").write.parquet(path)
    assert run() == [("a", 1, 2), ("a", 2, 2)]
    spark.createDataFrame([("a", 3), ("b", 4)], "k string, v int").write.mode("append").parquet(path)
    assert run() == [("a", 1, 3), ("a", 2, 3), ("a", 3, 3), ("b", 4, 1)]


def test_term_counts_and_postings(spark):
    docs = spark.createDataFrame([(1, "The cat, the hat. De la casa"), (2, "the THE cat's")], "doc long, text string")
    counts = tx.term_counts(docs)
    assert rows(counts) == [("casa", 1, 1), ("cat", 1, 1), ("cat's", 2, 1), ("hat", 1, 1),
                            ("the", 1, 2), ("the", 2, 2)]
    post = tx.postings(counts)
    assert rows(post.where("word = 'the'")) == [("the", 0, "(1,2), (2,2)")]
    post2 = tx.postings(counts, block_size=1, as_text=False)
    assert rows(post2.where("word = 'the'"), "block") == [(1,), (2,)]


def test_postings_sorted_by_count_then_doc(spark):
    counts = spark.createDataFrame([("w", 5, 1), ("w", 3, 4), ("w", 9, 4), ("w", 1, 2)], "word string, doc long, n long")
    assert tx.postings(counts).first()["postings"] == "(3,4), (9,4), (1,2), (5,1)"


def test_postings_string_doc_keys_blocked(spark):
    data = [("w", f"d{i}", 1) for i in range(50)]
    counts = spark.createDataFrame(data, "word string, doc string, n long")
    post = tx.postings(counts, block_size=10, as_text=False)
    sizes = [len(r.postings) for r in post.collect()]
    assert sum(sizes) == 50 and len(sizes) >= 2


def test_term_counts_property_sum_equals_kept_tokens(spark):
    from kestrel.plans import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    counts = tx.term_counts(docs, doc="doc_id")
    kept = tx.remove_stop_words(tx.tokens(docs, doc="doc_id"))
    assert counts.agg(F.sum("n")).first()[0] == kept.count()
    # a stop-word DataFrame gives the same result as the list
    from kestrel.sources import stop_words_frame

    via_df = tx.term_counts(docs, doc="doc_id", stop_words=stop_words_frame(spark))
    assert via_df.exceptAll(counts).count() == 0 and counts.exceptAll(via_df).count() == 0


def _fixture_graph(spark):
    # Fixture row 4: header + SEA->PDX x2, PDX->SEA, SEA->LAX, LAX->LAX.
    lines = ["Year,Origin,Dest", "2008,SEA,PDX", "2008,SEA,PDX", "2008,PDX,SEA", "2008,SEA,LAX", "2008,LAX,LAX"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    from kestrel.sources import parse_delimited

    flights = parse_delimited(df, "Year string, Origin string, Dest string", header_token="first")
    return g.vertices(flights, "Origin", "Dest"), g.edges(flights, "Origin", "Dest")


def test_graph_fixture(spark):
    v, e = _fixture_graph(spark)
    assert tuple(g.summary(v, e).first()) == (3, 4)
    assert rows(g.busiest(e)) == [("SEA", 3)]
    assert dict(rows(g.in_degrees(e)))["LAX"] == 2  # self-loop counts
    top = g.top_routes(e, 2).collect()
    assert [r.route for r in top] == ["SEA -> PDX: 2", "LAX -> LAX: 1"]  # ties broken by key (H11)
    assert [tuple(r) for r in g.least_in(v, e, 10).collect()] == [("PDX", 1), ("SEA", 1), ("LAX", 2)]
    assert [tuple(r) for r in g.most_out(v, e, 1).collect()] == [("SEA", 2)]
    assert g.triplets(v, e).count() == 4


def test_triplets_with_vertex_attributes(spark):
    v = spark.createDataFrame([("SEA", "Seattle"), ("PDX", "Portland")], "id string, city string")
    e = spark.createDataFrame([("SEA", "PDX", 2), ("SEA", "XXX", 1)], "src string, dst string, n long")
    t = g.triplets(v, e)
    assert rows(t, "src", "dst", "n", "src_city", "dst_city") == [("SEA", "PDX", 2, "Seattle", "Portland")]


def test_graph_properties_on_events(spark):
    from kestrel.plans.graph_queries import routes

    r = routes(spark, "/root/testdata/sf0.001")
    v, e = g.vertices(r), g.edges(r)
    total = r.count()
    assert e.agg(F.sum("n")).first()[0] == total  # edge weights sum to the input rows
    n_edges = e.count()
    assert g.in_degrees(e).agg(F.sum("degree")).first()[0] == n_edges
    assert g.out_degrees(e).agg(F.sum("degree")).first()[0] == n_edges
    assert g.summary(v, e).first()["n_edges"] == n_edges


def test_skew_safe_enrich_equals_plain_left_outer(spark):
    # One right key holds a third of the rows; nulls on both sides; duplicates fan out.
    import random

    rnd = random.Random(5)
    left = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b", "hot"]), i) for i in range(300)]
    right = [(2, "hot", j) for j in range(100)] + [
        (rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b", "c"]), 1000 + j) for j in range(200)
    ]
    l_df = spark.createDataFrame(left, "y int, m string, lid int")
    r_df = spark.createDataFrame(right, "ry int, rm string, rid int")
    on = [("y", "ry"), ("m", "rm")]
    plain = rel.enrich(l_df, r_df, on, skew_safe=False)
    split = rel.enrich(l_df, r_df, on, skew_safe=True)
    assert split.columns == plain.columns == ["y", "m", "lid", "rid"]
    assert rows(split) == rows(plain)
    assert "LeftAnti" in plan_text(split) and "LeftAnti" not in plan_text(plain)
    assert plain.count() > 300
    # the same columns on both paths, with right keys and with a name that both sides use
    same = r_df.withColumnRenamed("rid", "lid")
    for keep in (False, True):
        plain = rel.enrich(l_df, same, on, keep_right_keys=keep)
        split = rel.enrich(l_df, same, on, keep_right_keys=keep, skew_safe=True)
        names = ["y", "m", "lid", *(["ry", "rm"] if keep else []), "lid"]
        assert split.columns == plain.columns == names
        unique = [f"c{i}" for i in range(len(names))]
        assert rows(split.toDF(*unique)) == rows(plain.toDF(*unique))


def test_term_counts_custom_stop_words_keep_jvm_empties(spark):
    # Without "" in the stop list, empty tokens count like on the JVM: leading and
    # inner ones are kept, trailing ones are not.
    docs = spark.createDataFrame([(1, ",a,,b,,"), (2, "...")], "doc long, text string")
    counts = tx.term_counts(docs, stop_words=iter(["b"]))
    assert rows(counts) == [("", 1, 2), ("a", 1, 1)]


def test_postings_blocks_exact_for_large_ids(spark):
    big = 2**60 + 7
    counts = spark.createDataFrame([("w", big, 1), ("w", big + 1, 2)], "word string, doc long, n long")
    out = tx.postings(counts, block_size=2, as_text=False).collect()
    assert sorted(r.block for r in out) == [big // 2, (big + 1) // 2]


def test_skew_safe_enrich_plan_shape(spark):
    # With broadcasts off (large inputs), the left outer join is an inner join plus a
    # left-anti join against the aggregated distinct right keys.
    left = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select((F.col("id") % 5).alias("rk"), F.col("id").alias("w"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(rel.enrich(left, right, [("k", "rk")], skew_safe=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Union" in plan and "Inner" in plan and "LeftAnti" in plan and "LeftOuter" not in plan


def test_cluster_settings_scale_with_input():
    from kestrel.session import cluster_settings

    small = cluster_settings(10 << 30)
    big = cluster_settings(100 << 40)
    assert int(big["spark.sql.shuffle.partitions"]) > int(small["spark.sql.shuffle.partitions"]) >= 200
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(big["spark.sql.files.maxPartitionBytes"]) <= 256 << 20
    assert int(big["spark.sql.shuffle.partitions"]) <= 20_000


def test_shared_dir_needs_a_setting_on_a_cluster(spark, monkeypatch):
    from kestrel import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.remove_scratch(spark, "/root")


def test_postings_sorted_output_is_global_order(spark):
    from kestrel.plans import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    counts = tx.term_counts(docs, doc="doc_id")
    out = tx.postings(counts, doc="doc_id", block_size=50, sort=True)
    keys = [(r.word, r.block) for r in out.collect()]
    assert keys == sorted(keys) and len(keys) == len(set(keys))
    plan = plan_text(out)
    hashed = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert hashed and all("doc_id" in h for h in hashed)  # only the counts' shuffle is hashed
    assert "Exchange rangepartitioning(word" in plan  # the postings need just one range shuffle
    assert rows(out) == rows(tx.postings(counts, doc="doc_id", block_size=50))


def test_postings_by_rank_fill_their_blocks(spark):
    # a hot word in 95 documents with scattered numbers, string ids too
    docs = spark.createDataFrame([(i * 7_919_317, "hot" + (" rare" if i % 30 == 0 else "")) for i in range(95)], "doc_id long, text string")
    for df in (docs, docs.withColumn("doc_id", F.sha1(F.col("doc_id").cast("string")))):
        counts = tx.term_counts(df, doc="doc_id", text="text")
        out = tx.postings(counts, doc="doc_id", block_size=10, as_text=False, by_rank=True)
        sizes = {(r.word, r.block): len(r.postings) for r in out.collect()}
        assert sizes == {**{("hot", b): 10 for b in range(9)}, ("hot", 9): 5, ("rare", 0): 4}
        assert out.selectExpr("explode(postings) AS p").select("p.doc").distinct().count() == 95


def test_postings_of_dealt_counts_need_one_shuffle(spark):
    docs = spark.createDataFrame([(i % 150 - 30, f"hot w{i % 7} hot x{i}") for i in range(300)], "doc long, text string").repartition(3)
    plain = tx.postings(tx.term_counts(docs), block_size=20)
    dealt = tx.postings(tx.term_counts(docs, block_size=20), block_size=20, dealt=True)
    from .conftest import plan_text

    assert plan_text(dealt).count("Exchange hashpartitioning") == 1
    assert rows(dealt) == rows(plain)


@pytest.mark.parametrize("ids", ["long", "text"])
def test_postings_by_rank_join_blocks_over_slices(spark, monkeypatch, ids):
    # slices of about 13 documents, blocks of 5; a null document comes first, one document comes twice
    key = (lambda i: i * 7_919_317 % 10_007) if ids == "long" else (lambda i: f"d{i * 7_919_317 % 10_007}")
    data = [(key(i), " ".join(["hot"] * (1 + i % 3) + [f"w{i % 9}"])) for i in range(95)] + [(None, "hot w1 w1"), (key(4), "hot")]
    df = spark.createDataFrame(data, f"doc {'long' if ids == 'long' else 'string'}, text string").repartition(4)
    found = {}
    for doc, text in data:
        for w in text.split():
            found.setdefault(w, {}).setdefault(doc, 0)
            found[w][doc] += 1
    due = []
    for w, docs in found.items():
        order = sorted(docs.items(), key=lambda x: (x[0] is not None, x[0]))
        for b in range(0, len(order), 5):
            due.append((w, b // 5, [(d, n) for d, n in sorted(order[b : b + 5], key=lambda x: (-x[1], x[0] is not None, x[0]))]))
    dealt = tx.postings(tx.term_lists(df, slice_docs=13), block_size=5, as_text=False, by_rank=True, dealt=True)
    monkeypatch.setattr(tx, "SLICE_DOCS", 13)
    plain = tx.postings(tx.term_counts(df), block_size=5, as_text=False, by_rank=True, sort=True)
    for out in (dealt, plain):
        assert sorted((r.word, r.block, [tuple(p) for p in r.postings]) for r in out.collect()) == sorted(due, key=lambda x: x[:2])
        assert out.schema["block"].dataType.simpleString() == "bigint"


def test_postings_by_rank_shuffle_the_tokens_once(spark):
    df = spark.createDataFrame([(i, f"hot w{i % 7}") for i in range(50)], "doc long, text string")
    lists = tx.term_lists(df, slice_docs=10)
    assert plan_text(lists).count("Exchange hashpartitioning") == 1
