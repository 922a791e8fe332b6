"""Text classification with multinomial naive Bayes.

Two forms of the same model:

* :func:`fit` builds a spark.ml ``PipelineModel``: JVM-side tokenizer (split on
  one space like ``String.split``), ``HashingTF`` with 2^20 features (the
  original job's hashing size; hashing runs in the JVM, never in Python, see
  H14), ``NaiveBayes`` and ``IndexToString`` so
  that predictions are the original labels (H15). It transforms batch and
  streaming frames alike.
* :func:`fit_tables` / :func:`predict_tables` compute the exact model as plain
  DataFrame jobs: word counts per class are a grouped aggregate, scoring is a
  join of the rows' words with the per-word class counts and two sums per row.
  Nothing grows on the driver with the vocabulary (only the per-class totals,
  one row per label), so it scales with the data. With ``hashed=True`` the words
  are first mapped to ``feature_space`` numbers: the hashed model without
  gathering a class's whole vector in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import split_words
from ..session import scratch_path

HASH_FEATURES = 1 << 20


def tokenizer(text: str = "text", output: str = "words") -> RegexTokenizer:
    """M1 tokens: split on a single space, no lower-casing; trailing empties dropped like the JVM."""
    return RegexTokenizer(inputCol=text, outputCol=output, pattern=" ", gaps=True, toLowercase=False,
                          minTokenLength=0)


def features(df: DataFrame, text: str = "text", num_features: int = HASH_FEATURES,
             output: str = "features") -> DataFrame:
    """M1: hashed term-frequency vectors of the space-split text."""
    words = tokenizer(text, "_words").transform(df)
    return HashingTF(inputCol="_words", outputCol=output, numFeatures=num_features).transform(words).drop("_words")


def fit(
    df: DataFrame,
    text: str = "text",
    label: str = "label",
    smoothing: float = 1.0,
    num_features: int = HASH_FEATURES,
    prediction: str = "predicted_label",
) -> PipelineModel:
    """M2: fit tokenizer -> hashed features -> naive Bayes; ``prediction`` holds the label as text.

    spark.ml gathers one vector of ``num_features`` per label; for the exact model, or
    for labels with very many rows, use :func:`fit_tables`.
    """
    vec = HashingTF(inputCol="_words", outputCol="_features", numFeatures=num_features)
    indexer = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="error")
    labelled = df.withColumn(label, F.col(label).cast("string"))
    indexer_model = indexer.fit(labelled)
    stages = [
        tokenizer(text, "_words"),
        vec,
        NaiveBayes(featuresCol="_features", labelCol="_label", predictionCol="_prediction",
                   probabilityCol="_probability", rawPredictionCol="_raw", smoothing=smoothing,
                   modelType="multinomial"),
        IndexToString(inputCol="_prediction", outputCol=prediction, labels=indexer_model.labels),
    ]
    return Pipeline(stages=[indexer_model, *stages]).fit(labelled)


def predict(model: PipelineModel, df: DataFrame, prediction: str = "predicted_label") -> DataFrame:
    """M3: score a batch or streaming frame; helper columns are dropped."""
    out = model.transform(df)
    return out.drop("_words", "_features", "_label", "_prediction", "_probability", "_raw")


@dataclass
class NBTables:
    """Exact multinomial naive Bayes as a DataFrame plus the per-class totals."""

    word_counts: DataFrame  # (word, counts: array of (y, n)): occurrences of the word in the classes that have it
    labels: list  # class labels in index order (frequency desc, then text), like StringIndexer
    log_prior: list  # per class
    log_denominator: list  # per class: ln(tokens_c + V * smoothing)
    smoothing: float
    vocab_size: int  # rows of word_counts
    feature_space: int | None = None  # unseen words still weigh in (smoothed zero count)
    hashed: bool = False  # words are hash numbers below feature_space


def _words(text: str, hashed: bool, feature_space: int | None) -> Column:
    words = split_words(text)
    if not hashed:
        return words
    return F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(feature_space)).cast("string"))


#: Up to so many classes a word's counts and gains are columns side by side; beyond, rows.
WIDE_CLASSES = 64


def fit_tables(df: DataFrame, text: str = "text", label: str = "label", smoothing: float = 1.0,
               feature_space: int | None = None, hashed: bool = False) -> NBTables:
    """M2 (exact form): per-class word counts as a DataFrame; class totals on the driver.

    Smoothing spreads over the vocabulary unless ``feature_space`` is given: then over
    that many features, and words unseen in training still count at prediction (a
    smoothed zero count), which is the model a hashed feature space of that size gives,
    minus hash collisions; ``hashed=True`` adds those too (words become hash numbers).

    Words are counted per class side by side, pre-aggregated on the map side (beyond
    ``WIDE_CLASSES`` classes as rows (word, class, n)), so neither many classes nor a class with most
    of the rows gathers in one task. The word table is written to the shared folder.
    """
    if hashed and not feature_space:
        raise ValueError("hashed=True needs feature_space")
    rows = df.select(F.col(label).alias("_y"), F.col(text).alias("_t"))
    classes = rows.groupBy("_y").agg(F.count(F.lit(1)).alias("docs")).collect()  # one row per label
    classes.sort(key=lambda r: (-r["docs"], str(r["_y"])))
    labels = [r["_y"] for r in classes]

    toks = rows.select("_y", F.explode(_words("_t", hashed, feature_space)).alias("word"))
    # The model table is used by every later prediction (every micro-batch of a
    # stream): write it once to the shared folder, which also cuts its lineage (a lost
    # executor never re-runs the training) and tells the planner its size.
    if 0 < len(labels) <= WIDE_CLASSES:  # one shuffle, a count per class side by side
        label_type = rows.schema["_y"].dataType
        counts = [F.count(F.when(F.col("_y").eqNullSafe(F.lit(y)), 1)).alias(f"_n{i}") for i, y in enumerate(labels)]
        pairs = F.array(*[F.struct(F.lit(y).cast(label_type).alias("y"), F.col(f"_n{i}").alias("n")) for i, y in enumerate(labels)])
        word_counts = toks.groupBy("word").agg(*counts).select("word", F.filter(pairs, lambda c: c["n"] > 0).alias("counts"))
    else:
        counted = toks.groupBy("word", "_y").agg(F.count(F.lit(1)).alias("n"))
        word_counts = counted.groupBy("word").agg(F.collect_list(F.struct(F.col("_y").alias("y"), "n")).alias("counts"))
    path = scratch_path(df.sparkSession, "word-counts")
    word_counts.write.parquet(path)
    word_counts = df.sparkSession.read.schema(word_counts.schema).parquet(path)

    vocab = word_counts.count()
    per_class = word_counts.select(F.explode("counts").alias("c")).groupBy("c.y").agg(F.sum("c.n").alias("t"))
    tokens = {r["y"]: r["t"] for r in per_class.collect()}
    total_docs = sum(r["docs"] for r in classes)
    log_prior = [math.log(r["docs"] + smoothing) - math.log(total_docs + len(classes) * smoothing) for r in classes]
    space = feature_space or vocab
    log_den = [math.log(tokens.get(y, 0) + space * smoothing) for y in labels]
    return NBTables(word_counts, labels, log_prior, log_den, smoothing, vocab, feature_space, hashed)


def predict_tables(model: NBTables, df: DataFrame, doc: str = "doc_id", text: str = "text",
                   prediction: str = "prediction", keep: list[str] | None = None) -> DataFrame:
    """M3 (exact form): one prediction for every row of ``df``, with the columns ``keep`` (default: ``doc``).

    score(c) = log_prior(c) + sum over in-vocabulary words w of
    k(row, w) * (ln(n(c, w) + s) - ln_den(c)); unseen words are ignored unless the model
    has a feature space.

    Rows go by a 128-bit hash of their kept columns and text, so nothing depends on how rows are
    numbered when a task runs again; equal rows share one score and come back as often as they
    came in. The words are joined to the word table, by its written size: a small one is
    broadcast and each row's sums are made on the map side, else adaptive execution splits hot
    words. Texts and kept columns are not shuffled with the words; the scores are joined back once.
    """
    keep = [doc] if keep is None else keep
    names = [f"_kept{i}" for i in range(len(keep))]
    source = df.select(*[F.col(c).alias(k) for c, k in zip(keep, names, strict=True)], F.col(text).alias("_text"))
    rows = source.select(F.xxhash64(*names, "_text").alias("_k1"), F.xxhash64(F.lit(1), "_text", *names).alias("_k2"), *names, "_text")
    key = ["_k1", "_k2"]
    label_type = model.word_counts.schema["counts"].dataType.elementType["y"].dataType
    if not model.labels:
        return rows.select(*[F.col(k).alias(c) for c, k in zip(keep, names, strict=True)], F.lit(None).cast(label_type).alias(prediction))

    words = rows.select(*key, F.posexplode(_words("_text", model.hashed, model.feature_space)).alias("_at", "word"))
    scores = _wide_scores(model, words, key) if len(model.labels) <= WIDE_CLASSES else _long_scores(model, words, key)
    ln_s = math.log(model.smoothing)
    classes = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(y).cast(label_type).alias("y"), F.lit(p).alias("prior"), F.lit(d).alias("den"))
                        for i, (y, p, d) in enumerate(zip(model.labels, model.log_prior, model.log_denominator, strict=True))])

    def score(c: Column) -> Column:
        copies = F.coalesce("_copies", F.lit(1))
        own = F.coalesce(F.element_at("_gains", c["i"]), F.lit(0.0)) / copies
        known = F.coalesce("_known", F.lit(0)) / copies  # a row without words has no scores
        # Highest score wins; on a tie the earlier class (lower index) wins, as in spark.ml.
        return F.struct((c["prior"] + own + known * (F.lit(ln_s) - c["den"])).alias("score"), (-c["i"]).alias("order"), c["y"].alias("label"))

    joined = rows.drop("_text").join(scores, key, "left")
    best = F.array_max(F.transform(classes, score))
    return joined.select(*[F.col(k).alias(c) for c, k in zip(keep, names, strict=True)], best["label"].alias(prediction))


def _gain(model: NBTables, n: Column) -> Column:
    return F.log(n + F.lit(model.smoothing)) - F.lit(math.log(model.smoothing))


def _totals(hit: Column) -> list[Column]:
    """Known words, and copies of the row: its first word occurs once in each."""
    return [F.count(F.when(hit, 1)).alias("_known"), F.count(F.when(F.col("_at") == 0, 1)).alias("_copies")]


def _wide_scores(model: NBTables, words: DataFrame, key: list[str]) -> DataFrame:
    """key, _known, _copies, _gains (map from class index): one sum per class."""
    def of(y) -> Column:
        return F.coalesce(_gain(model, F.get(F.filter("counts", lambda c: c["y"].eqNullSafe(F.lit(y))), 0)["n"]), F.lit(0.0))

    table = model.word_counts.select("word", *[of(y).alias(f"_g{i}") for i, y in enumerate(model.labels)])
    hit = F.lit(True) if model.feature_space else F.col("_g0").isNotNull()
    sums = [F.sum(F.coalesce(f"_g{i}", F.lit(0.0))).alias(f"_g{i}") for i in range(len(model.labels))]
    summed = words.join(table, "word", "left").groupBy(*key).agg(*_totals(hit), *sums)
    pairs = [c for i in range(len(model.labels)) for c in (F.lit(i), F.col(f"_g{i}"))]
    return summed.select(*key, "_known", "_copies", F.create_map(*pairs).alias("_gains"))


def _long_scores(model: NBTables, words: DataFrame, key: list[str]) -> DataFrame:
    """The same with a row per class that shares a word with the text."""
    index = F.create_map(*[x for i, y in enumerate(model.labels) if y is not None for x in (F.lit(y), F.lit(i))])
    null = model.labels.index(None) if None in model.labels else None
    joined = words.join(model.word_counts, "word", "left")
    hit = F.lit(True) if model.feature_space else F.col("counts").isNotNull()
    totals = joined.groupBy(*key).agg(*_totals(hit))
    per_class = joined.select(*key, F.explode("counts").alias("_c"))
    at = F.coalesce(F.try_element_at(index, F.col("_c.y")), F.lit(null))
    gains = per_class.groupBy(*key, at.alias("_i")).agg(F.sum(_gain(model, F.col("_c.n"))).alias("_g"))
    gains = gains.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("_i", "_g"))).alias("_gains"))
    return totals.join(gains, key, "left")
