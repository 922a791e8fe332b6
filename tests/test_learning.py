"""ALS, k-means and naive Bayes (M1-M11) with H1, H3, H14, H15 and property tests."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from kestrel.functions import split_words
from kestrel.operators import classify as nb
from kestrel.operators import cluster as km
from kestrel.operators import recommend as rec
from kestrel.sources import parse_vectors

from .conftest import SF_SMALL, rows


def _ratings(spark):
    data = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(1, 9) for i in range(1, 11) if (u + i) % 3]
    return spark.createDataFrame(data, "userId int, movieId int, rating double")


def test_rating_stats(spark):
    r = _ratings(spark)
    n, users, items = r.agg(F.count("*"), F.countDistinct("userId"), F.countDistinct("movieId")).first()
    assert tuple(rec.rating_stats(r).first()) == (n, users, items)


def test_als_unseen_user_is_nan_and_not_a_false_positive(spark):
    # Fixture row 8 / H1.
    model = rec.fit(_ratings(spark), rank=3, max_iter=5, seed=7)
    test = spark.createDataFrame([(99, 1, 1.0), (1, 2, 1.0)], "userId int, movieId int, rating double")
    pred = rec.predict(model, test)
    got = {r.userId: r.prediction for r in pred.collect()}
    assert math.isnan(got[99]) and not math.isnan(got[1])
    items = spark.createDataFrame([(1, "One"), (2, "Two")], "movieId int, title string")
    fp = rec.false_positives(pred, items, low=1.0, high=-100.0)
    assert rows(fp, "userId") == [(1,)]  # the NaN row never counts
    assert rec.predict(model, test, cold_start="drop").count() == 1


def test_als_covers_every_known_pair(spark):
    r = _ratings(spark)
    model = rec.fit(r, rank=3, max_iter=5, seed=7)
    scored = rec.score_pairs(model, r.select("userId", "movieId"))
    assert scored.count() == r.count()
    assert scored.where(F.isnan("prediction")).count() == 0


def test_kmeans_fixture_groups(spark):
    # Fixture row 10: three tight groups plus a blank line.
    lines = ["1.0 1.1 1.0", "1.1 1.0 1.2", "1.2 1.2 1.1", "7.0 7.1 7.0", "7.1 7.0 7.2", "7.2 7.2 7.1",
             "7.0 1.1 1.0", "7.1 1.0 1.1", "", "7.2 1.2 1.0"]
    df = parse_vectors(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert df.count() == 9
    model = km.fit(df, k=3, max_iter=10, seed=1)
    pred = [r.prediction for r in km.predict(model, df).collect()]
    assert len(set(pred[0:3])) == len(set(pred[3:6])) == len(set(pred[6:9])) == 1
    assert len({pred[0], pred[3], pred[6]}) == 3
    centers = km.centers(model, spark)
    assert centers.count() == 3
    test = parse_vectors(spark.createDataFrame([("0.3 0.3 0.3",), ("8.0 8.0 8.0",), ("8.0 0.1 0.1",)], "value string"))
    assert len({r.prediction for r in km.predict(model, test).collect()}) == 3


def test_kmeans_prediction_is_nearest_center(spark):
    from kestrel.plans.ml_queries import _vectors

    data = _vectors(spark, SF_SMALL)
    model = km.fit(data, k=3, max_iter=10, seed=1)
    centers = np.array(model.clusterCenters())
    for r in km.predict(model, data).limit(200).collect():
        v = r.features.toArray()
        assert r.prediction == int(np.argmin(((centers - v) ** 2).sum(axis=1)))
    # same seed, same centres
    again = np.array(km.fit(data, k=3, max_iter=10, seed=1).clusterCenters())
    assert np.allclose(centers, again)


def _tweets(spark):
    data = [
        (0, "the soup was cold and grim"), (0, "grim weather and cold feet"), (0, "a cold grim evening"),
        (2, "the train leaves at six "), (2, "lunch is ready at noon"), (2, "the library opens at noon"),
        (4, "what a bright warm garden"), (4, "bright bright morning"), (4, "warm bread and bright faces"),
    ]
    return spark.createDataFrame(data, "polarity int, tweet string")


def test_tokenizer_matches_jvm_split(spark):
    df = spark.createDataFrame([("wait right here ",), ("aim  now",), ("   ",)], "t string")
    got = [r.w for r in nb.tokenizer("t", "w").transform(df).collect()]
    assert got == [["wait", "right", "here"], ["aim", "", "now"], []]  # H3
    same = [r.w for r in df.select(split_words("t").alias("w")).collect()]
    assert same == got  # the exact tables tokenize like the pipeline


def test_naive_bayes_predicts_original_labels(spark):
    # Labels 0/2/4 come back as labels, not class positions; H14: JVM hashing.
    train = _tweets(spark)
    model = nb.fit(train, text="tweet", label="polarity")
    test = spark.createDataFrame([("bright warm day",), ("cold grim soup",), ("wait right here ",)], "tweet string")
    preds = [int(r.predicted_label) for r in nb.predict(model, test).collect()]
    assert set(preds) <= {0, 2, 4}
    assert preds[0] == 4


def _count_model(train, docs, text, label):
    """spark.ml's naive Bayes on exact word counts: a second opinion on the tables."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer, IndexToString, StringIndexer

    train = train.withColumn(label, F.col(label).cast("string"))
    index = StringIndexer(inputCol=label, outputCol="_y").fit(train)
    stages = [index, nb.tokenizer(text, "_w"), CountVectorizer(inputCol="_w", outputCol="_f"),
              NaiveBayes(featuresCol="_f", labelCol="_y", predictionCol="_p"), IndexToString(inputCol="_p", outputCol="label_text", labels=index.labels)]
    fitted = Pipeline(stages=stages).fit(train)
    scored = docs.withColumn(label, F.lit(index.labels[0]))
    return {r.doc_id: int(r.label_text) for r in fitted.transform(scored).collect()}


def test_exact_tables_equal_spark_ml_count_model(spark):
    from kestrel.plans.ml_queries import training_docs

    train = training_docs(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    ml = _count_model(train, docs, "text", "label")
    tables = nb.fit_tables(train, text="text", label="label")
    exact = {r.doc_id: r.prediction for r in nb.predict_tables(tables, docs).collect()}
    assert exact == ml
    # on the literal tweets too (three classes)
    tw = _tweets(spark)
    with_id = tw.withColumn("doc_id", F.monotonically_increasing_id())
    ml3 = _count_model(tw, with_id, "tweet", "polarity")
    ex3 = {r.doc_id: r.prediction for r in nb.predict_tables(nb.fit_tables(tw, "tweet", "polarity"), with_id,
                                                               text="tweet").collect()}
    assert ml3 == ex3


def test_exact_predict_same_with_and_without_broadcast(spark):
    from kestrel.plans.ml_queries import training_docs

    from .conftest import plan_text

    tables = nb.fit_tables(training_docs(spark, SF_SMALL), text="text", label="label")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    small = nb.predict_tables(tables, docs)
    assert "BuildRight" in plan_text(small) or "BroadcastExchange" in plan_text(small)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = nb.predict_tables(tables, docs)
        assert "SortMergeJoin" in plan_text(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hashed_model_agrees_with_exact_model(spark):
    # M1: with 2^20 hashed features, naive Bayes smooths over 2^20 features; the exact
    # tables with the same feature space differ only where hashes collide, which is rare.
    from kestrel.plans.ml_queries import training_docs

    train = training_docs(spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    hashed = {r.doc_id: int(r.predicted_label) for r in nb.predict(nb.fit(train), docs).collect()}
    tables = nb.fit_tables(train, feature_space=nb.HASH_FEATURES)
    exact = {r.doc_id: r.prediction for r in nb.predict_tables(tables, docs).collect()}
    same = sum(hashed[d] == exact[d] for d in exact)
    assert same >= 0.99 * len(exact)


def test_every_post_gets_its_own_label(spark):
    train = spark.createDataFrame([("good good nice", 4), ("bad sad", 0), ("bad", 0)], "text string, label int")
    model = nb.fit_tables(train)
    posts = [("ann", "bad bad sad"), ("ann", "good"), ("bob", "good"), ("ann", "good"), ("cid", ""), ("cid", None), ("dan", "unknown words"), (None, "good")]
    df = spark.createDataFrame(posts, "name string, text string")
    got = rows(nb.predict_tables(model, df, keep=["name", "text"]))
    assert got == [(n, t, 4 if t == "good" else 0) for n, t in posts]
    assert len(nb.predict_tables(model, df, doc="name").collect()) == len(posts)


def test_hashed_tables_many_classes(spark):
    train = spark.createDataFrame([(f"w{i} w{i} x", i) for i in range(300)], "text string, label int")
    for options in ({}, {"feature_space": 1 << 20}, {"feature_space": 1 << 20, "hashed": True}):
        model = nb.fit_tables(train, **options)
        got = {r.doc_id: r.prediction for r in nb.predict_tables(model, train.withColumnRenamed("label", "doc_id")).collect()}
        assert got == {i: i for i in range(300)}


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    from kestrel.operators import recommend as rec

    ratings = spark.createDataFrame([(i % 20, i % 7, float(i % 5)) for i in range(200)], "userId int, movieId int, rating double")
    seen = {}
    real = rec.ALS

    def spy(**kwargs):
        seen.update(kwargs)
        return real(**kwargs)

    monkeypatch.setattr(rec, "ALS", spy)
    monkeypatch.setattr(rec, "RATINGS_PER_BLOCK", 10)
    rec.fit(ratings, max_iter=1)
    assert seen["numUserBlocks"] == seen["numItemBlocks"] == 20


def test_als_item_blocks_are_few_and_leave_the_model_alone(spark, monkeypatch):
    ratings = spark.createDataFrame([(i % 40, i * i % 31, float(i % 5)) for i in range(600)], "userId int, movieId int, rating double")
    seen, real = {}, rec.ALS

    def spy(**kwargs):
        seen.update(kwargs)
        return real(**kwargs)

    monkeypatch.setattr(rec, "ALS", spy)
    few = {r.id: r.features for r in rec.fit(ratings, max_iter=3).itemFactors.collect()}
    assert (seen["numUserBlocks"], seen["numItemBlocks"]) == (10, 4)
    many = {r.id: r.features for r in rec.fit(ratings, max_iter=3, num_blocks=10).itemFactors.collect()}
    assert few.keys() == many.keys()
    assert all(np.allclose(few[i], many[i], rtol=1e-3, atol=1e-4) for i in few)


def test_predictions_do_not_depend_on_row_order_and_repeats_come_back(spark):
    train = spark.createDataFrame([("good good nice", 4), ("bad sad", 0), ("bad meh", 2)], "text string, label int")
    posts = [("hot", "good day")] * 300 + [("hot", "bad sad")] * 5 + [("hot", None)] * 3 + [(None, "meh meh")]
    df = spark.createDataFrame(posts, "name string, text string").repartition(6)  # an unordered shuffle before
    for options in ({}, {"feature_space": 1 << 20}, {"feature_space": 1 << 20, "hashed": True}):
        model = nb.fit_tables(train, **options)
        got = rows(nb.predict_tables(model, df, keep=["name", "text"]).select("name", "text", "prediction"))
        assert {t: p for _, t, p in got if t} == {"good day": 4, "bad sad": 0, "meh meh": 2}
        assert sorted(map(repr, ((n, t) for n, t, _ in got))) == sorted(map(repr, posts))


def test_wide_and_long_scores_agree(spark, monkeypatch):
    train = spark.createDataFrame([(f"w{i % 9} w{i % 4} x", None if i == 3 else i % 7) for i in range(60)], "text string, label int")
    docs = spark.createDataFrame([(i, f"w{i % 9} w{i % 5} new x x") for i in range(40)] + [(99, "")], "doc_id long, text string")
    for options in ({}, {"feature_space": 1 << 10, "hashed": True}):
        model = nb.fit_tables(train, **options)
        wide = rows(nb.predict_tables(model, docs))
        monkeypatch.setattr(nb, "WIDE_CLASSES", 0)
        assert rows(nb.predict_tables(model, docs)) == wide
        monkeypatch.undo()
    empty = nb.fit_tables(train.where("false"))
    assert rows(nb.predict_tables(empty, docs.limit(1))) == [(0, None)]


def test_feature_facts_read_stored_values_only(spark, tmp_dir, monkeypatch):
    from kestrel.plans import ml_queries

    def dense(*_):
        raise AssertionError("an array of all 2^20 features for each text")

    monkeypatch.setattr(ml_queries, "vector_to_array", dense)
    texts = ["a b a", "", "   ", "x  y ", "b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    assert tuple(ml_queries.nb_features_facts(spark, tmp_dir).first()) == (5, 8.0)  # the inner empty word counts


def test_als_ratings_are_joined_once(spark, tmp_dir):
    from kestrel.plans import ml_queries

    spark.createDataFrame([(i, i % 5) for i in range(40)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_dir}/orders.parquet")
    lines = spark.createDataFrame([(i % 40, i % 7, i % 4, 1990 + i % 12) for i in range(300)], "l_orderkey long, l_partkey long, l_linenumber int, y int")
    lines = lines.selectExpr("l_orderkey", "l_partkey", "l_linenumber", "make_date(nullif(y, 1995), 6, 1)::timestamp_ntz AS l_shipdate")
    lines.write.parquet(f"{tmp_dir}/lineitem.parquet")
    train, test = ml_queries._split(spark, tmp_dir)
    assert (train.count(), test.count()) == (200, 75)  # a line without a date is in neither
    assert train.columns == test.columns == ["userId", "movieId", "rating"]
    assert all("parquet" in f and "ratings-" in f for df in (train, test) for f in df.inputFiles())
