"""Matrix-factorisation recommender: train, predict pairs, and serve top lists in both directions."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.learning.estimators import SEED
from loamwork.learning.serving import top_lists
from loamwork.operators.aggregates import distinct_counts
from loamwork.operators.joins import lookup_join
from loamwork.operators.positions import dense_index
from loamwork.workspace import shared_dir

_INT_MAX = 2**31 - 1
#: Blocks of each side of a factoriser at least, and ratings of a block, about, where the caller names no number of blocks.
BLOCKS, BLOCK_RATINGS = 10, 4_000_000


def profile(ratings: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Numbers of ratings, users and items."""
    return distinct_counts(ratings, {"n_users": user, "n_items": item}, total="n_ratings")


def with_int_ids(ratings: DataFrame, *columns: str) -> DataFrame:
    """Ids the factoriser accepts: cast when every value fits an int, else replaced by a dense index."""
    whole = {name for name, kind in ratings.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}
    numbers = {c: F.col(c) if c in whole else F.col(c).try_cast("bigint") for c in columns}
    fits = ratings.agg(*[
        F.min(F.coalesce(n, F.lit(-1)).between(0, _INT_MAX).cast("int")) for n in numbers.values()
    ]).first()
    for column, ok in zip(columns, fits):
        if ok:
            ratings = ratings.withColumn(column, numbers[column].cast("int"))
        else:
            index = dense_index(ratings, column, "_idx").withColumnRenamed(column, "_key")
            ratings = (
                ratings.join(index, F.col(column).eqNullSafe(F.col("_key")))
                .withColumn(column, F.col("_idx").cast("int")).drop("_key", "_idx")
            )
    return ratings


def rating_blocks(ratings: DataFrame) -> int:
    """Blocks of each side for so many ratings: a task sorts those of a block in memory, so their number follows from the rows."""
    return max(BLOCKS, -(-ratings.count() // BLOCK_RATINGS))


def factoriser(rank: int = 5, iterations: int = 20, regularisation: float = 0.1, blocks: int = BLOCKS,
               user: str = "user_id", item: str = "item_id", rating: str = "rating") -> ALS:
    """Explicit-feedback factoriser; pairs with an unknown user or item get no prediction.

    ``blocks`` is the number of user and of item blocks, and so of tasks in a stage.
    """
    return ALS(
        rank=rank, maxIter=iterations, regParam=regularisation, numUserBlocks=blocks, numItemBlocks=blocks,
        userCol=user, itemCol=item, ratingCol=rating, seed=SEED, coldStartStrategy="drop",
        checkpointInterval=5,
    )


def train(ratings: DataFrame, **settings) -> ALSModel:
    """Fit the factoriser. Factors depend on ``blocks`` and not on the cluster; without it they follow from the number of ratings.

    The learner reads the ratings and deals them to its blocks by id, so they are neither dealt nor cached before. More blocks send
    a factor to more of them: beyond the least number, a checkpoint in every iteration lets go of its shuffle files.
    """
    shared_dir(ratings.sparkSession)
    if "blocks" in settings:
        return factoriser(**settings).fit(ratings)
    blocks = rating_blocks(ratings)
    estimator = factoriser(blocks=blocks, **settings)
    return estimator.setCheckpointInterval(1).fit(ratings) if blocks > BLOCKS else estimator.fit(ratings)


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for (user, item) rows; unknown users and items drop out."""
    return model.transform(pairs)


def _exploded(lists: DataFrame, key: str, other: str) -> DataFrame:
    return lists.select(key, F.posexplode("recommendations").alias("_at", "_r")).select(
        key, (F.col("_at") + 1).alias("place"), F.col(f"_r.{other}").alias(other),
        F.col("_r.rating").alias("score"),
    )


def _searched(asked: DataFrame, own: DataFrame, key: str, other_factors: DataFrame, other: str, n: int) -> DataFrame:
    """Lists of the given ids by exact search; ids without a factor have none."""
    known = asked.select(F.col(key).cast("int").alias("id")).distinct().join(own, "id")
    found = top_lists(known, other_factors, n)
    return found.select(F.col("id").alias(key), "place", F.col("other").alias(other), "score")


def top_items(model: ALSModel, n: int, users: DataFrame | None = None) -> DataFrame:
    """(user_id, place, item_id, score) of the best items for the given users, by search in blocks of falling norm.

    Without ``users`` it is a batch job over all of them: every user block meets every item block, users x items scores.
    """
    user, item = model.getUserCol(), model.getItemCol()
    if users is None:
        return _exploded(model.recommendForAllUsers(n), user, item)
    return _searched(users, model.userFactors, user, model.itemFactors, item, n)


def top_users(model: ALSModel, n: int, items: DataFrame | None = None) -> DataFrame:
    """(item_id, place, user_id, score) of the best users for the given items; all items is a batch job as in :func:`top_items`."""
    user, item = model.getUserCol(), model.getItemCol()
    if items is None:
        return _exploded(model.recommendForAllItems(n), item, user)
    return _searched(items, model.itemFactors, item, model.userFactors, user, n)


def with_titles(recommended: DataFrame, items: DataFrame, item: str = "item_id") -> DataFrame:
    """Attach item titles; ``items`` has one row per item."""
    return lookup_join(recommended, items, [item], "left")


def serve(
    spark: SparkSession, path: str, direction: str, key: int, n: int, titles: DataFrame
) -> DataFrame:
    """Top list from a saved model: ``direction`` "U" gives items for a user, "M" gives users for an item."""
    model = ALSModel.load(path)
    if direction == "U":
        asked = spark.createDataFrame([(key,)], f"{model.getUserCol()} int")
        return with_titles(top_items(model, n, asked), titles, model.getItemCol())
    if direction == "M":
        asked = spark.createDataFrame([(key,)], f"{model.getItemCol()} int")
        return with_titles(top_users(model, n, asked), titles, model.getItemCol())
    raise ValueError("direction is U or M")
