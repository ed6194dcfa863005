"""Metrics of scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, functions as F


def hard_label_auc(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Area under ROC when the 0/1 prediction itself is the score: one interior point, one aggregate.

    This and the other frame metrics give one row, or one per group of ``by``, such as the split a row is in. Rows of a single
    class have no curve and count as one half.
    """
    positive, called = F.col(label) > 0.5, F.col(prediction) > 0.5
    rates = scored.groupBy(*by).agg(
        F.avg(F.when(positive, called.cast("double"))).alias("tpr"),
        F.avg(F.when(~positive, called.cast("double"))).alias("fpr"),
    )
    return rates.select(*by, F.coalesce((1 + F.col("tpr") - F.col("fpr")) / 2, F.lit(0.5)).alias("auc"))


def score_auc(scored: DataFrame, label: str = "label", score: str = "rawPrediction") -> float:
    """Exact area under ROC of a score or raw-prediction column; equal scores share their rank."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=0
    ).evaluate(scored)


def accuracy(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def rmse(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return scored.groupBy(*by).agg(F.sqrt(F.avg(F.pow(F.col(prediction) - F.col(label), 2))).alias("rmse"))


def coverage_rmse(
    predicted: DataFrame, actual: DataFrame, keys: Sequence[str], prediction: str = "prediction",
    rating: str = "rating",
) -> DataFrame:
    """Root of the squared error over predicted pairs divided by the number of all actual pairs.

    ``predicted`` has one row per pair; pairs without a prediction count in the divisor only.
    """
    error = F.pow(F.col(prediction) - F.col(rating), 2)
    joined = actual.select(*keys, rating).join(predicted.select(*keys, prediction), list(keys), "left")
    squares = F.coalesce(F.sum(error), F.lit(0.0))
    return joined.agg(F.sqrt(squares / F.count(F.lit(1))).alias("rmse"))


def one_number(frame: DataFrame) -> float:
    """The only cell of a metric frame."""
    return float(frame.first()[0])
