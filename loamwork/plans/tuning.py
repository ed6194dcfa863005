"""Tuning (G) over the whole value lists of ``loamwork.learning.tune``."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.sql import DataFrame, Window, functions as F

from loamwork.learning import estimators, evaluate, features, recommend, rules, sweeps, tune
from loamwork.operators.splits import hash_bucket
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.workspace import held, shared_dir, spread


def _document_features(t, scale=None):
    """Train, validation and test rows with features fitted on the training rows."""
    parts = derived.document_splits(t)
    with held(parts["train"]) as train:
        stages = Pipeline(stages=features.mixed_features(["lang"], derived.NUMBERS, scale)).fit(train)
    return {n: stages.transform(p).select("doc_id", "label", "features") for n, p in parts.items()}


def _auc(scored):
    return evaluate.one_number(evaluate.hard_label_auc(scored))


def _sweep_documents(t, estimator, grid, scale=None):
    rows = _document_features(t, scale)
    return tune.sweep_estimator(estimator, rows["train"], rows["validation"], _auc, grid, larger_is_better=True)


def _sweep_trees(t, grid):
    """One growth per impurity and number of bins, all settings judged at once."""
    rows = _document_features(t)
    return sweeps.sweep_trees(estimators.tree_classifier(), rows["train"], rows["validation"], evaluate.hard_label_auc, grid, larger_is_better=True)


def _axes(axes, **usual):
    """Every value of each axis, one axis at a time, the others at their usual values."""
    return [point for axis, values in axes.items() for point in tune.one_axis(axis, values, **{k: v for k, v in usual.items() if k != axis})]


def _grid_sql(grid):
    """The twin of a sweep: its settings in order, exactly one best, and what held of every trial."""
    names = list(grid[0])
    rows = ", ".join("(" + ", ".join([str(i), *[f"'{point[n]}'" for n in names]]) + ")" for i, point in enumerate(grid))
    return f"SELECT CAST(grid_position AS INTEGER) AS grid_position, {', '.join(names)}, true AS timed, true AS in_range, CAST(1 AS BIGINT) AS n_best, true AS best_is_extreme FROM (VALUES {rows}) AS g(grid_position, {', '.join(names)})"


def _held(table, metric, larger=True, top=1.0):
    """The settings of a sweep table, with facts about each trial and about the best one, computed from the table."""
    everything = Window.partitionBy()
    extreme = (F.max if larger else F.min)(metric).over(everything)
    names = [c for c in table.columns if c not in (metric, "seconds", "is_best")]
    return table.select(
        *names, (F.col("seconds") > 0).alias("timed"), F.col(metric).between(0, top).alias("in_range"),
        F.count_if("is_best").over(everything).alias("n_best"),
        (F.max(F.when(F.col("is_best"), F.col(metric))).over(everything) == extreme).alias("best_is_extreme"),
    )


#: Hours of a year by weekday: some ten thousand rows, whatever the number of events.
_HOUR_PARTS = 4
_TREE_USUAL = {"impurity": "entropy", "maxDepth": 10, "maxBins": 10}
_TREE_AXES = _axes(tune.TREE_AXES, **_TREE_USUAL)
_LOGISTIC_AXES = _axes(tune.LOGISTIC_AXES, iterations=15, step=10, batch_fraction=0.5)
_SVM_AXES = _axes(tune.SVM_AXES, iterations=15, step=10, regularisation=0.01)
_ALS_AXES = _axes(tune.ALS_AXES, rank=8, maxIter=10, regParam=0.1)
_TREE_GRID = tune.settings_grid(**tune.TREE_AXES)
_ONE_TREE = [{"impurity": "entropy", "maxDepth": 10, "maxBins": 200}]


@query("g01_train_and_evaluate")
def train_and_evaluate(t):
    return _sweep_documents(t, estimators.tree_classifier(), _ONE_TREE).table(t.spark, "auc")


@query("g01_trial_facts", _grid_sql(_ONE_TREE))
def trial_facts(t):
    """E07 with it: every trial has a positive duration."""
    return _held(train_and_evaluate(t), "auc")


@query("g02_axis_sweep_tree")
def axis_sweep_tree(t):
    return _sweep_trees(t, _TREE_AXES).table(t.spark, "auc")


@query("g02_tree_axis_facts", _grid_sql(_TREE_AXES))
def tree_axis_facts(t):
    return _held(axis_sweep_tree(t), "auc")


def _sweep_sgd(t, kind, grid):
    rows = _document_features(t, "standard")
    return sweeps.sweep_descents(kind, rows["train"], rows["validation"], evaluate.hard_label_auc, grid).table(t.spark, "auc")


@query("g02b_axis_sweep_logistic", _grid_sql(_LOGISTIC_AXES))
def axis_sweep_logistic(t):
    return _held(_sweep_sgd(t, estimators.logistic_descent, _LOGISTIC_AXES), "auc")


@query("g02c_axis_sweep_svm", _grid_sql(_SVM_AXES))
def axis_sweep_svm(t):
    return _held(_sweep_sgd(t, estimators.hinge_descent, _SVM_AXES), "auc")


@query("g02d_axis_sweep_bayes")
def axis_sweep_bayes(t):
    grid = tune.one_axis("smoothing", tune.BAYES_AXES["smoothing"])
    return _sweep_documents(t, estimators.naive_bayes(), grid, "deviation").table(t.spark, "auc")


_SMOOTHINGS = ", ".join(f"({i}, {value})" for i, value in enumerate(tune.BAYES_AXES["smoothing"]))


@query("g02d_bayes_metric_by_smoothing", f"""
WITH {derived.BINARY_SQL},
parted AS (SELECT *, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS bucket FROM pages_in),
numbers AS (
  SELECT doc_id, bucket, label, 0 AS slot, n_chars AS value FROM parted UNION ALL
  SELECT doc_id, bucket, label, 1, n_spaces FROM parted UNION ALL SELECT doc_id, bucket, label, 2, n_lines FROM parted),
train AS (SELECT * FROM numbers WHERE bucket < 8),
grid(grid_position, smoothing) AS (VALUES {_SMOOTHINGS}),
sums AS (SELECT label AS class, slot, sum(value) AS s FROM train GROUP BY label, slot),
totals AS (SELECT class, sum(s) AS total FROM sums GROUP BY class),
classes AS (SELECT label AS class, count(DISTINCT doc_id) AS n FROM train GROUP BY label),
weights AS (
  SELECT grid_position, class, slot, ln(s + smoothing) - ln(total + 3 * smoothing) AS theta,
         ln(n + smoothing) - ln((SELECT sum(n) FROM classes) + smoothing * (SELECT count(*) FROM classes)) AS prior
  FROM sums JOIN totals USING (class) JOIN classes USING (class), grid),
scores AS (
  SELECT grid_position, doc_id, label, class, max(prior) + sum(theta * value) AS score
  FROM numbers JOIN weights USING (slot) WHERE bucket = 8 GROUP BY grid_position, doc_id, label, class),
called AS (SELECT grid_position, doc_id, label, arg_max(class, score) AS prediction FROM scores GROUP BY grid_position, doc_id, label)
SELECT CAST(grid_position AS INTEGER) AS grid_position,
       round(coalesce((1 + avg(prediction) FILTER (label = 1) - avg(prediction) FILTER (label = 0)) / 2, 0.5), 6) AS auc
FROM called GROUP BY grid_position""")
def bayes_metric_by_smoothing(t):
    stage = features.assembler(derived.NUMBERS)
    rows = {n: stage.transform(p) for n, p in derived.document_splits(t).items()}
    grid = tune.one_axis("smoothing", tune.BAYES_AXES["smoothing"])
    done = tune.sweep_estimator(
        estimators.naive_bayes(), rows["train"], rows["validation"], _auc, grid, larger_is_better=True
    )
    return done.table(t.spark, "auc").select("grid_position", F.round("auc", 6).alias("auc"))


def _factor_sweep(t):
    parts = derived.rating_splits(t)
    shared_dir(t.spark)
    return sweeps.sweep_factors(recommend.factoriser(), parts["train"], parts["validation"], _ALS_AXES)


@query("g02e_axis_sweep_factors", _grid_sql(_ALS_AXES))
def axis_sweep_factors(t):
    return _held(_factor_sweep(t)[0].table(t.spark, "rmse"), "rmse", larger=False, top=10.0)


@query("g02e_predicted_pairs", f"""
WITH {derived.RATINGS_SQL},
parted AS (SELECT *, ('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS bucket FROM ratings),
train AS (SELECT * FROM parted WHERE bucket < 8), judged AS (SELECT * FROM parted WHERE bucket = 8)
SELECT CAST(range AS INTEGER) AS position, (SELECT count(*) FROM judged) AS n,
  (SELECT count(*) FROM judged WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)) AS n_predicted
FROM range({len(_ALS_AXES)})""")
def predicted_pairs(t):
    """Per setting, the pairs to predict and those with both sides known."""
    return _factor_sweep(t)[1]


@query("g03_full_sweep", _grid_sql(_TREE_GRID))
def full_sweep(t):
    """Every combination; the best model is kept and serves the test rows."""
    rows = _document_features(t)
    done = sweeps.sweep_trees(
        estimators.tree_classifier(), rows["train"], rows["validation"], evaluate.hard_label_auc, _TREE_GRID, larger_is_better=True
    )
    nodes, depth = done.best.model
    served = rules.routed(rows["test"], nodes, depth).withColumnRenamed("value", "prediction")
    if not 0 <= _auc(served) <= 1:
        raise ValueError("the best model does not score")
    return _held(done.table(t.spark, "auc"), "auc")


@query("g04_parameter_grid")
def parameter_grid(t):
    parts = derived.hour_splits(t)
    tree = estimators.tree_regressor(label="cnt")
    grid = tune.param_grid(tree, maxDepth=[5, 10, 15, 25], maxBins=[25, 35, 45, 50])
    stages = Pipeline(stages=[features.assembler(derived.HOUR_FEATURES)])
    with spread(stages.fit(parts["train"]).transform(parts["train"]), _HOUR_PARTS) as rows:
        fitted = [tree.fit(rows, params) for params in grid]
    settings = [
        (i, *[int(m.getOrDefault(n)) for n in ("maxDepth", "maxBins")], int(m.depth), int(m.numNodes))
        for i, m in enumerate(fitted)
    ]
    return t.spark.createDataFrame(settings, "grid_position int, maxDepth int, maxBins int, depth int, nodes int")


def _binary():
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")


@query("g05_holdout_binary")
def holdout_binary(t):
    tree = estimators.tree_classifier("gini")
    grid = tune.param_grid(tree, impurity=["gini", "entropy"], maxDepth=[5, 10, 15], maxBins=[10, 15, 20])
    tuner = tune.holdout_tuner(features.mixed_features(["lang"], derived.NUMBERS), tree, _binary(), grid)
    with spread(derived.document_splits(t)["train"]) as train:
        return tune.tuning_table(t.spark, tuner.fit(train).stages[-1])


@query("g05_holdout_multiclass")
def holdout_multiclass(t):
    tree = estimators.gathered_tree("gini")
    grid = tune.param_grid(tree, impurity=["gini", "entropy"], maxDepth=[10, 15, 25], maxBins=[30, 40, 50])
    # Fits of few tasks each, side by side.
    tuner = tune.holdout_tuner([], tree, MulticlassClassificationEvaluator(metricName="accuracy"), grid, parallelism=12)
    with spread(derived.vector_splits(t)["train"]) as train:
        return tune.tuning_table(t.spark, tuner.fit(train).stages[-1])


@query("g06_folds_regression")
def folds_regression(t):
    tree = estimators.tree_regressor(label="cnt")
    grid = tune.param_grid(tree, maxDepth=[5, 10, 15, 25], maxBins=[25, 35, 45, 50])
    stages = [features.assembler(derived.HOUR_FEATURES, "assembled"), features.category_slots(24)]
    tuner = tune.fold_tuner(stages, tree, RegressionEvaluator(labelCol="cnt", metricName="rmse"), grid, parallelism=8)
    with spread(derived.hour_splits(t)["train"], _HOUR_PARTS) as train:
        return tune.tuning_table(t.spark, tuner.fit(train).stages[-1])


@query("g06_folds_boosted")
def folds_boosted(t):
    boosted = estimators.boosted_regressor(label="cnt")
    grid = tune.param_grid(boosted, maxDepth=[5, 10], maxBins=[25, 40], maxIter=[10, 50])
    stages = [features.assembler(derived.HOUR_FEATURES, "assembled"), features.category_slots(24)]
    tuner = tune.fold_tuner(stages, boosted, RegressionEvaluator(labelCol="cnt", metricName="rmse"), grid, parallelism=8)
    with spread(derived.hour_splits(t)["train"], _HOUR_PARTS) as train:
        return tune.tuning_table(t.spark, tuner.fit(train).stages[-1])


@query("g07_metric_by_parameter")
def metric_by_parameter(t):
    table = _sweep_trees(t, _TREE_AXES).table(t.spark, "auc")
    # Each axis in turn is the parameter of its own part of the sweep.
    parts, start = [], 0
    for axis, values in tune.TREE_AXES.items():
        own = table.where(F.col("grid_position").between(start, start + len(values) - 1))
        parts.append(own.select(F.lit(axis).alias("parameter"), F.col(axis).alias("value"), "auc", "seconds"))
        start += len(values)
    return reduce(DataFrame.unionAll, parts)


#: Hours are dealt to three folds by their calendar place, so that SQL knows the folds.
_FOLD_GRID = tune.settings_grid(maxDepth=[5, 10, 15, 25], maxBins=[25, 35, 45, 50])


def _folded_hours(t, categories=True):
    """(fold, label, features) of hours; without ``categories`` all features are numbers, which any number of bins can split."""
    hour = F.concat_ws(":", F.col("day_of_year").cast("string"), F.col("hr").cast("string"))
    rows = derived.stored(t, derived.hours(t).withColumn("fold", hash_bucket(hour, 3).cast("int")), "folded-hours")
    stages = [features.assembler(derived.HOUR_FEATURES, "assembled"), features.category_slots(24)] if categories else [features.assembler(derived.HOUR_FEATURES)]
    ready = Pipeline(stages=stages).fit(rows).transform(rows)
    return ready.select("fold", F.col("cnt").alias("label"), "features")


@query("g06_folds_by_depth")
def folds_by_depth(t):
    """Cross-validation of a regression tree: one growth per fold and number of bins serves every depth."""
    done, _ = sweeps.sweep_folds(estimators.tree_regressor(), _folded_hours(t), evaluate.rmse, _FOLD_GRID, larger_is_better=False)
    return done.table(t.spark, "rmse")


@query("g03_full_sweep_multiclass")
def full_sweep_multiclass(t):
    parts = derived.vector_splits(t)
    grid = tune.settings_grid(impurity=["gini", "entropy"], maxDepth=[3, 5, 10, 15, 20, 25], maxBins=[3, 5, 10, 50, 100, 200])
    done = sweeps.sweep_trees(estimators.tree_classifier(), parts["train"], parts["test"], evaluate.accuracy, grid, larger_is_better=True, parallelism=12, least=1)
    return done.table(t.spark, "accuracy")


@query("g03_full_sweep_regression")
def full_sweep_regression(t):
    """Down to three bins, fewer than an hour of the day has values: hours and weekdays are numbers here."""
    rows = _folded_hours(t, categories=False)
    grid = tune.settings_grid(maxDepth=[3, 5, 10, 15, 20, 25], maxBins=[3, 5, 10, 50, 100, 200])
    return sweeps.sweep_trees(estimators.tree_regressor(), rows.where("fold < 2"), rows.where("fold = 2"), evaluate.rmse, grid, larger_is_better=False).table(t.spark, "rmse")


@query("g03_full_sweep_logistic")
def full_sweep_logistic(t):
    """Sixty settings on twelve paths: as many jobs as the longest has iterations."""
    return _sweep_sgd(t, estimators.logistic_descent, tune.settings_grid(**tune.LOGISTIC_AXES))


@query("g03_full_sweep_svm")
def full_sweep_svm(t):
    return _sweep_sgd(t, estimators.hinge_descent, tune.settings_grid(**tune.SVM_AXES))
