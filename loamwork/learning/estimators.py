"""Estimators with the settings the classic programs start from, and model descriptions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

SEED = 42


def _growth(depth: int) -> dict:
    """More nodes per pass over the rows; deep trees also keep each row's node instead of walking the tree."""
    return {"maxMemoryInMB": 1024, "cacheNodeIds": depth > 15}


# Fixed values: (impurity, maxDepth, maxBins) of the default runs.
BINARY_TREE = ("entropy", 10, 200)
COVER_TREE = ("entropy", 15, 50)
REGRESSION_TREE = ("variance", 10, 100)


def tree_classifier(impurity: str = BINARY_TREE[0], depth: int = BINARY_TREE[1], bins: int = BINARY_TREE[2],
                    label: str = "label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        labelCol=label, impurity=impurity, maxDepth=depth, maxBins=bins, seed=SEED, **_growth(depth)
    )


#: Rows of a partition of a gathered tree, at the most.
GATHERED_ROWS = 500_000


class GatheredTree(DecisionTreeClassifier):
    """A tree grown over as few partitions as its rows need, which keep their order.

    Every partition sends its counts of all features, bins and classes for every node that is split. In deep trees over wide vectors these
    outweigh the rows. What was drawn per partition before, such as the rows held out by a tuner, stays as it was.
    """

    def _fit(self, dataset: DataFrame):
        return super()._fit(dataset.coalesce(max(1, -(-dataset.count() // GATHERED_ROWS))))


def gathered_tree(impurity: str = BINARY_TREE[0], depth: int = BINARY_TREE[1], bins: int = BINARY_TREE[2], label: str = "label") -> GatheredTree:
    return GatheredTree(labelCol=label, impurity=impurity, maxDepth=depth, maxBins=bins, seed=SEED, **_growth(depth))


def tree_regressor(depth: int = REGRESSION_TREE[1], bins: int = REGRESSION_TREE[2],
                   label: str = "label") -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        labelCol=label, maxDepth=depth, maxBins=bins, seed=SEED, **_growth(depth)
    )


def forest_classifier(trees: int = 10, label: str = "label", **settings) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, numTrees=trees, seed=SEED, **settings)


def forest_regressor(trees: int = 20, label: str = "label", **settings) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, numTrees=trees, seed=SEED, **settings)


def boosted_regressor(label: str = "label", **settings) -> GBTRegressor:
    return GBTRegressor(labelCol=label, seed=SEED, **settings)


def logistic(iterations: int = 15, regularisation: float = 0.01, label: str = "label") -> LogisticRegression:
    """Logistic regression. Features are standardised by the feature stages, not again here."""
    return LogisticRegression(
        labelCol=label, maxIter=iterations, regParam=regularisation, standardization=False
    )


def linear_svm(iterations: int = 3, regularisation: float = 1.0, label: str = "label") -> LinearSVC:
    return LinearSVC(labelCol=label, maxIter=iterations, regParam=regularisation, standardization=False)


def naive_bayes(smoothing: float = 60.0, label: str = "label") -> NaiveBayes:
    return NaiveBayes(labelCol=label, smoothing=smoothing, modelType="multinomial")


@dataclass(frozen=True)
class LinearModel:
    """Weights of a linear classifier without intercept."""

    weights: list[float]


@dataclass(frozen=True)
class Descent:
    """Settings of one gradient descent; ``loss`` is "logistic" or "hinge"."""

    loss: str
    iterations: int
    step: float
    batch_fraction: float = 1.0
    regularisation: float = 0.0

    @property
    def path(self) -> tuple:
        """Descents that differ in the number of iterations alone share their path."""
        return self.loss, self.step, self.batch_fraction, self.regularisation


def _pull(loss: str, label: Column, margin: Column) -> Column:
    """The factor of a row's features in the gradient, from its label and margin."""
    if loss == "logistic":
        return 1 / (1 + F.exp(-margin)) - label
    sign = 2 * label - 1
    return F.when(sign * margin < 1, -sign).otherwise(0.0)


def descend(train: DataFrame, descents: Sequence[Descent], finished: Callable[[int], None] = lambda position: None) -> list[LinearModel]:
    """Mini-batch gradient descents over (label, features) rows, all in step: one aggregate in the JVM moves every one of them.

    A sweep takes as many jobs as its longest descent has iterations. Shorter ones on the same path are met on the way and not
    descended again. Steps shrink with the square root of their number. The batch of a step is drawn by a hash of the row and the
    step, so it is the same on any cluster. ``finished`` is told the position of each descent that has its weights.
    """
    size = train.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    longest: dict[tuple, int] = {}
    for d in descents:
        longest[d.path] = max(longest.get(d.path, 0), d.iterations)
    weights = {path: np.zeros(size) for path in longest}
    models: list[LinearModel | None] = [LinearModel([0.0] * size) if not d.iterations else None for d in descents]
    for t in range(1, max(longest.values(), default=0) + 1):
        live = [path for path, iterations in longest.items() if t <= iterations]
        draw = F.pmod(F.xxhash64("features", "label", F.lit(t)), F.lit(1_000_000))
        rows = train.select("features", F.col("label").cast("double").alias("label"), draw.alias("draw"))
        sums = []
        for k, path in enumerate(live):
            loss, _, fraction, _ = path
            drawn = F.col("draw") < int(fraction * 1_000_000)
            rows = rows.withColumn(f"w{k}", F.when(drawn, _pull(loss, F.col("label"), linear_margin(weights[path]))).otherwise(0.0))
            # Weights of a weighted mean are not negative, nor all zero: up and down are averaged apart, each one higher.
            up, down = F.greatest(F.col(f"w{k}"), F.lit(0.0)) + 1, F.greatest(-F.col(f"w{k}"), F.lit(0.0)) + 1
            sums += [
                Summarizer.mean(F.col("features"), up).alias(f"up_mean{k}"), Summarizer.mean(F.col("features"), down).alias(f"down_mean{k}"),
                F.sum(up).alias(f"ups{k}"), F.sum(down).alias(f"downs{k}"), F.count_if(drawn).alias(f"n{k}"),
            ]
        found = rows.agg(*sums).first()
        for k, path in enumerate(live):
            if found[f"n{k}"]:
                _, step, _, regularisation = path
                gradient = found[f"ups{k}"] * found[f"up_mean{k}"].toArray() - found[f"downs{k}"] * found[f"down_mean{k}"].toArray()
                rate = step / t**0.5
                weights[path] = weights[path] * (1 - rate * regularisation) - rate * gradient / found[f"n{k}"]
        for i, d in enumerate(descents):
            if d.iterations == t:
                models[i] = LinearModel(weights[d.path].tolist())
                finished(i)
    return models


def logistic_descent(iterations: int = 15, step: float = 10.0, batch_fraction: float = 0.5) -> Descent:
    return Descent("logistic", iterations, step, batch_fraction)


def hinge_descent(iterations: int = 3, step: float = 50.0, regularisation: float = 1.0) -> Descent:
    return Descent("hinge", iterations, step, 1.0, regularisation)


def sgd_logistic(train: DataFrame, iterations: int = 15, step: float = 10.0, batch_fraction: float = 0.5) -> LinearModel:
    """Logistic regression by mini-batch gradient descent, with its own knobs."""
    return descend(train, [logistic_descent(iterations, step, batch_fraction)])[0]


def sgd_svm(train: DataFrame, iterations: int = 3, step: float = 50.0, regularisation: float = 1.0) -> LinearModel:
    """Linear SVM: hinge-loss gradient descent over all rows with an L2 penalty; see :func:`linear_svm` for the default."""
    return descend(train, [hinge_descent(iterations, step, regularisation)])[0]


def linear_margin(weights: Sequence[float], features: str = "features") -> Column:
    """Margin of a linear model as a column expression; the weights are one array constant."""
    constant = F.from_json(F.lit(json.dumps([float(w) for w in weights])), "array<double>")
    products = F.zip_with(vector_to_array(features), constant, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def linear_predictions(models: Sequence[LinearModel], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(kept columns, position, prediction): the 0/1 predictions of many linear models in one pass, one row per model."""
    calls = F.array(*[(linear_margin(m.weights) > 0).cast("double") for m in models])
    return df.select(*keep, F.posexplode(calls).alias("position", "prediction"))


def sgd_predict(model: LinearModel, df: DataFrame) -> DataFrame:
    """Add the 0/1 prediction of a descended model: margin above 0, probability above one half alike."""
    return df.withColumn("prediction", (linear_margin(model.weights) > 0).cast("double"))


def rule_lines(spark, model) -> DataFrame:
    """(line_number, line) of a tree model's rules."""
    lines = list(enumerate(model.toDebugString.rstrip("\n").split("\n")))
    return spark.createDataFrame(lines, "line_number int, line string")


def importances(spark, model) -> DataFrame:
    """(slot, importance) of a tree model's features."""
    values = [(i, float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return spark.createDataFrame(values, "slot int, importance double")
