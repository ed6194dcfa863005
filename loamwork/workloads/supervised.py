"""Classification and regression over prepared rows: fit, evaluate and tune any model family."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from loamwork.functions.numeric import clamp_negative
from loamwork.learning import estimators, evaluate, features
from loamwork.learning.tune import Sweep, sweep
from loamwork.workspace import held, spread


@dataclass(frozen=True)
class Task:
    """What the rows look like and how a model on them is judged."""

    categories: Sequence[str]
    numbers: Sequence[str]
    label: str
    metric: Callable[[DataFrame, str], float]
    larger_is_better: bool
    max_categories: int | None = None


def hard_auc(scored: DataFrame, label: str) -> float:
    return evaluate.one_number(evaluate.hard_label_auc(scored, label))


def accuracy(scored: DataFrame, label: str) -> float:
    return evaluate.one_number(evaluate.accuracy(scored, label))


def rmse(scored: DataFrame, label: str) -> float:
    return evaluate.one_number(evaluate.rmse(scored, label))


@dataclass(frozen=True)
class Family:
    """A kind of model: how its features are scaled, and how it is trained on (label, features) rows."""

    train: Callable[..., object]
    scale: str | None = None
    non_negative: bool = False


def _estimated(factory: Callable) -> Callable[..., object]:
    return lambda rows, **settings: factory(**settings).fit(rows)


FAMILIES = {
    "tree": Family(_estimated(estimators.tree_classifier)),
    "forest": Family(_estimated(estimators.forest_classifier)),
    "logistic": Family(_estimated(estimators.logistic), scale="standard"),
    "svm": Family(_estimated(estimators.linear_svm), scale="standard"),
    "logistic_sgd": Family(estimators.sgd_logistic, scale="standard"),
    "svm_sgd": Family(estimators.sgd_svm, scale="standard"),
    "bayes": Family(_estimated(estimators.naive_bayes), scale="deviation", non_negative=True),
    "tree_regressor": Family(_estimated(estimators.tree_regressor)),
    "forest_regressor": Family(_estimated(estimators.forest_regressor)),
    "boosted_regressor": Family(_estimated(estimators.boosted_regressor)),
}


@dataclass
class Fitted:
    """Feature stages fitted on the training rows, and the model trained on their output."""

    task: Task
    family: Family
    stages: PipelineModel
    model: object

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows with features and a ``prediction``."""
        ready = self.stages.transform(_ready(self.task, self.family, rows))
        if hasattr(self.model, "transform"):
            return self.model.transform(ready)
        return estimators.sgd_predict(self.model, ready)

    def evaluate(self, rows: DataFrame) -> float:
        return self.task.metric(self.transform(rows), self.task.label)


def _ready(task: Task, family: Family, rows: DataFrame) -> DataFrame:
    if not family.non_negative:
        return rows
    return rows.withColumns({c: clamp_negative(F.col(c)) for c in task.numbers})


def _fit_stages(task: Task, family: Family, train: DataFrame) -> PipelineModel:
    if task.max_categories is not None:
        stages = [features.assembler(task.numbers, "assembled"), features.category_slots(task.max_categories)]
    else:
        stages = features.mixed_features(task.categories, task.numbers, family.scale)
    return Pipeline(stages=stages).fit(_ready(task, family, train))


def _points(task: Task, family: Family, stages: PipelineModel, rows: DataFrame) -> DataFrame:
    return features.labelled_points(stages.transform(_ready(task, family, rows)), task.label)


def fit(task: Task, family: str, train: DataFrame, **settings) -> Fitted:
    """Fit one model with the given settings."""
    kind = FAMILIES[family]
    with held(train):
        stages = _fit_stages(task, kind, train)
    with spread(_points(task, kind, stages, train)) as points:
        return Fitted(task, kind, stages, kind.train(points, **settings))


def tune(
    task: Task, family: str, train: DataFrame, validation: DataFrame, grid: Sequence[Mapping], parallelism: int = 4
) -> tuple[Sweep, Fitted]:
    """Try every setting, judged on the validation rows; features are fitted once, on the training rows."""
    kind = FAMILIES[family]
    stages = _fit_stages(task, kind, train)
    seen, unseen = [_points(task, kind, stages, rows) for rows in (train, validation)]
    with spread(seen) as points, held(unseen):
        def judge(model) -> float:
            if hasattr(model, "transform"):
                return task.metric(model.transform(unseen), "label")
            return task.metric(estimators.sgd_predict(model, unseen), "label")

        done = sweep(
            lambda **settings: kind.train(points, **settings), judge, grid, task.larger_is_better, parallelism
        )
    return done, Fitted(task, kind, stages, done.best.model)
