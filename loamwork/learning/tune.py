"""Parameter sweeps, hold-out tuning and cross-validation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock
from time import perf_counter

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession

from loamwork.learning.estimators import SEED
from loamwork.workspace import held, spread

# The value lists of the classic sweeps.
TREE_AXES = {"impurity": ["gini", "entropy"], "maxDepth": [3, 5, 10, 15, 20, 25], "maxBins": [3, 5, 10, 50, 100, 200]}
LOGISTIC_AXES = {"iterations": [5, 15, 20, 60, 100], "step": [10, 50, 100, 200], "batch_fraction": [0.5, 0.8, 1]}
SVM_AXES = {"iterations": [1, 3, 5, 15, 25], "step": [10, 50, 100, 200], "regularisation": [0.01, 0.1, 1]}
BAYES_AXES = {"smoothing": [1.0, 3.0, 5.0, 15.0, 25.0, 30.0, 35.0, 40.0, 45.0, 50.0, 60.0]}
ALS_AXES = {"rank": [5, 10, 15, 20, 50, 100], "maxIter": [5, 10, 15, 20, 25], "regParam": [0.05, 0.1, 1.0, 5.0, 10.0]}


def settings_grid(**axes: Sequence) -> list[dict]:
    """Every combination of the axes, the last axis varying fastest."""
    return [dict(zip(axes, values)) for values in product(*axes.values())]


def one_axis(axis: str, values: Sequence, **fixed) -> list[dict]:
    """Settings that vary one axis and hold the others."""
    return [{**fixed, axis: value} for value in values]


def param_grid(estimator, **axes: Sequence) -> list:
    """The same grid as Spark ML parameter maps of an estimator."""
    builder = ParamGridBuilder()
    for name, values in axes.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


@dataclass
class Trial:
    """One fit of a sweep; the model only of the best one."""

    position: int
    settings: dict
    metric: float
    seconds: float
    model: object


def train_and_evaluate(
    train: Callable[..., object], evaluate: Callable[[object], float], settings: Mapping, position: int = 0
) -> Trial:
    """Fit with one setting, evaluate, and time both together."""
    began = perf_counter()
    model = train(**settings)
    metric = evaluate(model)
    return Trial(position, dict(settings), metric, perf_counter() - began, model)


@dataclass
class Sweep:
    """Trials in grid order and the best of them; ties go to the earlier setting."""

    trials: list[Trial]
    larger_is_better: bool

    @property
    def best(self) -> Trial:
        sign = -1 if self.larger_is_better else 1
        return min(self.trials, key=lambda t: (sign * t.metric, t.position))

    def table(self, spark: SparkSession, metric: str) -> DataFrame:
        """One row per trial: position, settings as text, metric, seconds, and whether it is the best."""
        names = list(self.trials[0].settings)
        best = self.best.position
        rows = [
            (t.position, *[str(t.settings[n]) for n in names], float(t.metric), float(t.seconds), t.position == best)
            for t in self.trials
        ]
        columns = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame(
            rows, f"grid_position int, {columns}, {metric} double, seconds double, is_best boolean"
        )


def sweep(
    train: Callable[..., object], evaluate: Callable[[object], float], grid: Sequence[Mapping],
    larger_is_better: bool, parallelism: int = 4,
) -> Sweep:
    """Fit and evaluate every setting, several at a time. The callers' frames should be cached.

    Only the best model so far is kept, so a long grid does not hold one model per setting.
    """
    lock, sign, best = Lock(), -1 if larger_is_better else 1, []

    def trial(job):
        done = train_and_evaluate(train, evaluate, job[1], job[0])
        with lock:
            if not best or (sign * done.metric, done.position) < (sign * best[0].metric, best[0].position):
                for earlier in best:
                    earlier.model = None
                best[:] = [done]
            else:
                done.model = None
        return done

    run = inheritable_thread_target(SparkSession.active())(trial)
    pool = ThreadPool(min(parallelism, len(grid)))
    try:
        trials = pool.map(run, list(enumerate(grid)), chunksize=1)
    finally:
        pool.close()
    return Sweep(trials, larger_is_better)


def sweep_estimator(
    estimator, train: DataFrame, validation: DataFrame, score: Callable[[DataFrame], float],
    grid: Sequence[Mapping], larger_is_better: bool, parallelism: int = 4,
) -> Sweep:
    """Sweep a Spark ML estimator over settings, scoring each model on the validation rows."""
    with spread(train) as rows, held(validation):
        return sweep(
            lambda **settings: estimator.copy({estimator.getParam(k): v for k, v in settings.items()}).fit(rows),
            lambda model: score(model.transform(validation)),
            grid, larger_is_better, parallelism,
        )


def holdout_tuner(stages: Sequence, estimator, evaluator, grid: list, ratio: float = 0.8,
                  parallelism: int = 4) -> Pipeline:
    """Feature stages fitted once, then train-validation tuning as the last stage."""
    tuner = TrainValidationSplit(
        estimator=estimator, evaluator=evaluator, estimatorParamMaps=grid,
        trainRatio=ratio, seed=SEED, parallelism=parallelism,
    )
    return Pipeline(stages=[*stages, tuner])


def fold_tuner(stages: Sequence, estimator, evaluator, grid: list, folds: int = 3, fold_column: str = "",
               parallelism: int = 4) -> Pipeline:
    """Feature stages fitted once, then k-fold cross-validation as the last stage."""
    tuner = CrossValidator(
        estimator=estimator, evaluator=evaluator, estimatorParamMaps=grid,
        numFolds=folds, foldCol=fold_column, seed=SEED, parallelism=parallelism,
    )
    return Pipeline(stages=[*stages, tuner])


def tuning_table(spark: SparkSession, tuned) -> DataFrame:
    """(grid_position, settings, metric, is_best) of a fitted tuner."""
    metrics = getattr(tuned, "avgMetrics", None) or tuned.validationMetrics
    pick = max if tuned.getEvaluator().isLargerBetter() else min
    best = metrics.index(pick(metrics))
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(s.items(), key=lambda pair: pair[0].name)), float(m), i == best)
        for i, (s, m) in enumerate(zip(tuned.getEstimatorParamMaps(), metrics))
    ]
    return spark.createDataFrame(rows, "grid_position int, settings string, metric double, is_best boolean")
