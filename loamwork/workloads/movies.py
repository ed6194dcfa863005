"""Film recommendations: read ratings and titles, train, tune, save and serve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.learning import evaluate, recommend
from loamwork.learning.tune import Sweep, sweep_estimator
from loamwork.operators.splits import split_frames
from loamwork.sources import schemas
from loamwork.sources.readers import read_delimited
from loamwork.workspace import shared_dir

PAIR = ["user_id", "item_id"]


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.RATINGS, sep="\t").select(
        *PAIR, F.col("rating").cast("float").alias("rating")
    )


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.items(), sep="|").select("item_id", "title")


def split_ratings(ratings: DataFrame, weights: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Train, validation and test ratings, 8:1:1 unless given, decided by a hash of the pair."""
    pair = F.concat_ws(":", *[F.col(c).cast("string") for c in PAIR])
    return split_frames(ratings, pair, weights or {"train": 8, "validation": 1, "test": 1})


def rating_error(model: ALSModel, ratings: DataFrame) -> float:
    """Root of the squared error over predicted pairs divided by the number of all pairs."""
    scored = model.transform(ratings)
    return evaluate.one_number(evaluate.coverage_rmse(scored, ratings, PAIR))


def tune_ratings(
    train: DataFrame, validation: DataFrame, grid: Sequence[Mapping], parallelism: int = 2, blocks: int = 10
) -> Sweep:
    """Sweep over ``rank``, ``maxIter`` and ``regParam``, with the same ``blocks`` as :func:`recommend.train` is given."""
    shared_dir(train.sparkSession)
    return sweep_estimator(
        recommend.factoriser(blocks=blocks), train, validation,
        lambda scored: evaluate.one_number(evaluate.coverage_rmse(scored, validation, PAIR)),
        grid, larger_is_better=False, parallelism=parallelism,
    )
