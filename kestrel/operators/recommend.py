"""Collaborative filtering (M4-M8, A6, A7, J3, P10) with spark.ml ALS.

ALS is block-partitioned and distributed by spark.ml; its periodic lineage
checkpoints go to the session's checkpoint folder (see ``kestrel.session``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir
from .ordered import _written, running


#: A factor goes once to each block of the other side that needs it, so the bytes shuffled per iteration
#: grow with the number of blocks until all of a key's ratings lie in different ones. Few, large blocks
#: keep them in line with the keys: at this size a block is some 320 MB, twice that while it is built.
RATINGS_PER_BLOCK = 32_000_000
#: The fewest blocks. User factors start from random numbers drawn block by block, so the number of user
#: blocks is part of a model's result; item factors are computed from them, in however many blocks.
MIN_USER_BLOCKS, MIN_ITEM_BLOCKS = 10, 4


def rating_stats(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """One row ``(n_ratings, n_users, n_items)`` in one aggregation (exact distincts)."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct(F.col(user)).alias("n_users"),
        F.count_distinct(F.col(item)).alias("n_items"),
    )


def fit(
    ratings: DataFrame,
    rank: int = 10,
    max_iter: int = 10,
    seed: int = 42,
    user: str = "userId",
    item: str = "movieId",
    rating: str = "rating",
    reg_param: float = 0.1,
    cold_start: str = "nan",
    num_blocks: int | None = None,
) -> ALSModel:
    """M4: fit ALS (rank 10, 10 iterations by default, as in the original job).

    Each iteration runs one task per user block and per item block and moves factors
    between all pairs of blocks. By default a block holds about ``RATINGS_PER_BLOCK``
    ratings (one count of the ratings; at least 10 user and 4 item blocks), so the number of pairs
    follows the data and not the size of the cluster. Few item blocks mean few copies of the
    user factors, the larger half of the bytes moved. Keys must fit an int, as spark.ml's ALS demands.
    """
    shared_dir(ratings.sparkSession)  # ALS checkpoints its factor lineage here
    needed = num_blocks or -(-ratings.count() // RATINGS_PER_BLOCK)
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        seed=seed,
        coldStartStrategy=cold_start,
        checkpointInterval=5,
        numUserBlocks=num_blocks or max(MIN_USER_BLOCKS, needed),
        numItemBlocks=num_blocks or max(MIN_ITEM_BLOCKS, needed),
    )
    return als.fit(ratings)


def predict(model: ALSModel, df: DataFrame, cold_start: str = "nan") -> DataFrame:
    """M5: add a float ``prediction``; unseen users/items give NaN (``"nan"``) or are dropped (``"drop"``)."""
    model.setColdStartStrategy(cold_start)
    return model.transform(df)


@dataclass
class KeyedModel:
    """An ALS model over users and items of any type, with their dictionaries (key, id)."""

    model: ALSModel
    users: DataFrame
    items: DataFrame
    user: str
    item: str


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """``(key, id)``: the distinct non-null values of ``column`` with dense ids 0, 1, ...

    The values are range-partitioned and numbered with one offset per partition
    (:func:`kestrel.operators.ordered.running`); the table is written to the shared folder, so ids stay what they are.
    """
    keys = df.select(F.col(f"`{column}`").alias("key")).where("key IS NOT NULL").distinct()
    path = scratch_path(df.sparkSession, "dictionary")
    numbered = running(keys, ["key"], number="id", unique=True).select("key", (F.col("id") - 1).alias("id"))
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


#: spark.ml's ALS takes ids below this.
MAX_IDS = 2**31 - 1


def _with_ids(df: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str) -> DataFrame:
    """``df`` plus ``_user`` and ``_item``; -1 where a key is null or in no dictionary."""
    for ids, column, name in ((users, user, "_user"), (items, item, "_item")):
        found = ids.select(F.col("key").alias("_key"), F.col("id").cast("int").alias("_id"))
        df = df.join(found, F.col(f"`{column}`") == F.col("_key"), "left").withColumn(name, F.coalesce("_id", F.lit(-1))).drop("_key", "_id")
    return df


def fit_keyed(ratings: DataFrame, user: str = "userId", item: str = "movieId", rating: str = "rating", **options) -> KeyedModel:
    """M4 for string or 64-bit users and items: :func:`fit` over dictionary ids.

    Rows with a null user, item or rating are left out. ``options`` as for :func:`fit`.
    """
    users, items = dictionary(ratings, user), dictionary(ratings, item)
    for ids, name in ((users, user), (items, item)):
        n = ids.count()
        if n > MAX_IDS:
            raise ValueError(f"{n} different values of {name}; ALS takes at most {MAX_IDS}")
    coded = _with_ids(ratings.where(F.col(rating).isNotNull()), users, items, user, item).where("_user >= 0 AND _item >= 0")
    # written once: the fit reads its ratings more than once, and each time would join the wide keys again
    coded = _written(coded.select("_user", "_item", F.col(rating).alias("_rating")))
    model = fit(coded, user="_user", item="_item", rating="_rating", **options)
    return KeyedModel(model, users, items, user, item)


def predict_keyed(model: KeyedModel, df: DataFrame, cold_start: str = "nan") -> DataFrame:
    """M5 for :func:`fit_keyed`: ``df`` plus ``prediction``; null and unseen keys give NaN or are dropped.

    The factors get their own keys first, so each row of ``df`` is dealt twice: by its user and by
    its item, not also by their ids.
    """
    columns = df.columns
    for found, column, name in zip(factors(model), (model.user, model.item), ("_u", "_i"), strict=True):
        found = found.select(F.col("key").alias("_key"), F.col("features").alias(name))
        df = df.join(found, F.col(f"`{column}`") == F.col("_key"), "left").drop("_key")
    # summed in single precision, in order, as ALSModel does
    product = F.aggregate(F.zip_with("_u", "_i", lambda a, b: a * b), F.lit(0).cast("float"), lambda s, x: s + x)
    known = F.col("_u").isNotNull() & F.col("_i").isNotNull()
    if cold_start == "drop":
        df = df.where(known)
    return df.select(*[F.col(f"`{c}`") for c in columns], F.when(known, product).otherwise(F.lit(float("nan")).cast("float")).alias("prediction"))


def factors(model: KeyedModel) -> tuple[DataFrame, DataFrame]:
    """``(key, features)`` of the users and of the items, under their own keys."""
    users, items = ((ids.join(f, "id").select("key", "features")) for ids, f in ((model.users, model.model.userFactors), (model.items, model.model.itemFactors)))
    return users, items


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """M6: predictions for given ``(user, item)`` pairs (no rating column needed)."""
    return predict(model, pairs, "nan")


def false_positives(
    predictions: DataFrame,
    items: DataFrame,
    low: float = 1.0,
    high: float = 4.0,
    item: str = "movieId",
    user: str = "userId",
    title: str = "title",
    limit: int | None = None,
) -> DataFrame:
    """Rated at most ``low`` but predicted at least ``high``, with titles.

    ``limit`` gives the first ``limit`` rows in (user, item) order, a repeatable
    sample (the original printed 100 arbitrary rows); by default all rows.

    NaN predictions (unseen keys) are excluded: Spark orders NaN above every
    number, so ``NaN >= high`` would otherwise be true (H1). The join is a plain
    equi-join on the item key (the original wrote it as a filtered cartesian).
    """
    hits = predictions.where(
        (F.col("rating") <= F.lit(low)) & ~F.isnan("prediction") & (F.col("prediction") >= F.lit(high))
    )
    out = hits.join(items.select(item, title), item).select(user, item, title, "rating", "prediction")
    return out.orderBy(user, item, "rating", "prediction").limit(limit) if limit is not None else out
