"""Sweeps and descents whose weights and metrics SQL computes from the tables.

Gradient descent over three scaled numbers is a recursive statement: a step's weights follow from the averages of the last
step's gradient. Stumps and naive Bayes follow from counts.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from loamwork.learning import estimators, evaluate, features, sweeps, tune
from loamwork.operators.splits import hash_bucket
from loamwork.plans import derived
from loamwork.plans.checked import _ROWS, _rows
from loamwork.plans.registry import query
from loamwork.workspace import held, spread

_PARTED_SQL = f"""
{derived.BINARY_SQL},
parted AS (SELECT *, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS bucket FROM pages_in)"""


def _descents_sql(loss: str, paths: list[tuple], longest: int) -> str:
    """weights (path, t, w1, w2, w3) after every step; paths are (step, regularisation)."""
    listed = ", ".join(f"({i}, {float(step)}, {float(regularisation)})" for i, (step, regularisation) in enumerate(paths))
    margin = "(w1 * x1 + w2 * x2 + w3 * x3)"
    pull = f"1 / (1 + exp(-{margin})) - label" if loss == "logistic" else f"CASE WHEN (2 * label - 1) * {margin} < 1 THEN 1 - 2 * label ELSE 0 END"
    moved = ", ".join(f"w{k} * (1 - step / sqrt(t + 1) * reg) - step / sqrt(t + 1) * avg(g * x{k})" for k in (1, 2, 3))
    scaled = ", ".join(f"({c} - (SELECT avg({c}) FROM parted WHERE bucket < 8)) / (SELECT stddev_samp({c}) FROM parted WHERE bucket < 8) AS x{k}" for k, c in enumerate(derived.NUMBERS, 1))
    return f"""
WITH RECURSIVE {_PARTED_SQL},
scaled AS (SELECT doc_id, label, bucket, {scaled} FROM parted),
train AS (SELECT * FROM scaled WHERE bucket < 8),
paths(path, step, reg) AS (VALUES {listed}),
weights AS (
  SELECT path, 0 AS t, step::DOUBLE AS step, reg::DOUBLE AS reg, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS w3 FROM paths
  UNION ALL
  SELECT path, t + 1, step, reg, {moved}
  FROM (SELECT path, t, step, reg, w1, w2, w3, x1, x2, x3, {pull} AS g FROM weights, train WHERE t < {longest})
  GROUP BY path, t, step, reg, w1, w2, w3
)"""


def _sweep_sql(loss: str, grid: list[dict], columns: str = "CAST(grid_position AS INTEGER) AS grid_position, round(auc, 6) AS auc") -> str:
    """The metric of every setting on the rows of the ninth bucket."""
    paths = sorted({(p["step"], p.get("regularisation", 0.0)) for p in grid})
    points = ", ".join(f"({i}, {paths.index((p['step'], p.get('regularisation', 0.0)))}, {p['iterations']})" for i, p in enumerate(grid))
    return f"""{_descents_sql(loss, paths, max(p["iterations"] for p in grid))},
points(grid_position, path, t) AS (VALUES {points}),
called AS (SELECT grid_position, label, CASE WHEN w1 * x1 + w2 * x2 + w3 * x3 > 0 THEN 1.0 ELSE 0.0 END AS prediction
  FROM points JOIN weights USING (path, t), scaled WHERE bucket = 8),
metrics AS (SELECT grid_position, coalesce((1 + avg(prediction) FILTER (label = 1) - avg(prediction) FILTER (label = 0)) / 2, 0.5) AS auc FROM called GROUP BY grid_position)
SELECT {columns} FROM metrics"""


def _numbers(t):
    """Train and validation rows of the three numbers, scaled by the training rows."""
    parts = derived.document_splits(t)
    with held(parts["train"]) as train:
        stages = Pipeline(stages=features.mixed_features([], derived.NUMBERS, "standard")).fit(train)
    return {n: stages.transform(p).select("label", "features") for n, p in parts.items()}


def _weights(t, descent):
    with spread(_numbers(t)["train"]) as train:
        model = estimators.descend(train, [descent])[0]
    rows = [(i, round(w, 6)) for i, w in enumerate(model.weights)]
    return t.spark.createDataFrame(rows, "slot int, weight double")


_SLOTS = ", ".join(f"({k - 1}, w{k})" for k in (1, 2, 3))


@query("t09_descended_weights", f"{_descents_sql('logistic', [(1, 0)], 15)} SELECT CAST(slot AS INTEGER) AS slot, round(weight, 6) AS weight FROM weights, LATERAL (VALUES {_SLOTS}) AS s(slot, weight) WHERE t = 15")
def descended_logistic(t):
    return _weights(t, estimators.logistic_descent(15, 1.0, 1.0))


@query("t10_descended_weights", f"{_descents_sql('hinge', [(1, 0.01)], 15)} SELECT CAST(slot AS INTEGER) AS slot, round(weight, 6) AS weight FROM weights, LATERAL (VALUES {_SLOTS}) AS s(slot, weight) WHERE t = 15")
def descended_svm(t):
    return _weights(t, estimators.hinge_descent(15, 1.0, 0.01))


_ONE = [{"iterations": 15, "step": 1.0}]
_LOGISTIC = [*tune.one_axis("iterations", [1, 5, 15, 20], step=1.0), *tune.one_axis("step", [0.1, 0.5, 2.0], iterations=15)]
_HINGE = [
    *tune.one_axis("iterations", [1, 3, 5, 15, 25], step=1.0, regularisation=0.01), *tune.one_axis("step", [0.1, 0.5, 2.0], iterations=15, regularisation=0.01),
    *tune.one_axis("regularisation", [0.1, 0.5], iterations=15, step=1.0),
]
_GRID = tune.settings_grid(iterations=[1, 5, 15, 20], step=[0.1, 0.5, 1.0, 2.0])


def _sweep(t, kind, grid):
    rows = _numbers(t)
    return sweeps.sweep_descents(kind, rows["train"], rows["validation"], evaluate.hard_label_auc, grid).table(t.spark, "auc")


def _logistic(iterations, step):
    return estimators.logistic_descent(iterations, step, 1.0)


def _metrics(table):
    return table.select("grid_position", F.round("auc", 6).alias("auc"))


@query("g01_descended_trial", _sweep_sql("logistic", _ONE))
def descended_trial(t):
    return _metrics(_sweep(t, _logistic, _ONE))


@query("g02b_descended_axes", _sweep_sql("logistic", _LOGISTIC))
def descended_axes(t):
    return _metrics(_sweep(t, _logistic, _LOGISTIC))


@query("g02c_descended_axes", _sweep_sql("hinge", _HINGE))
def descended_hinge_axes(t):
    return _metrics(_sweep(t, estimators.hinge_descent, _HINGE))


@query("g03_descended_grid", _sweep_sql("logistic", _GRID, "CAST(grid_position AS INTEGER) AS grid_position, round(auc, 6) AS auc, round(auc, 6) = max(round(auc, 6)) OVER () AS is_largest"))
def descended_grid(t):
    """Every combination, and those with the largest metric; the best trial must be one of them."""
    table = _sweep(t, _logistic, _GRID)
    best = table.agg(F.max(F.when(F.col("is_best"), F.col("auc"))).alias("best"))
    return table.join(F.broadcast(best)).select("grid_position", F.round("auc", 6).alias("auc"), (F.round("auc", 6) == F.round("best", 6)).alias("is_largest"))


_PARAMETERS = " ".join(f"WHEN {i} THEN '{'iterations' if i < 4 else 'step'}={p['iterations'] if i < 4 else p['step']}'" for i, p in enumerate(_LOGISTIC))


@query("g07_descended_chart", _sweep_sql("logistic", _LOGISTIC, f"CASE grid_position {_PARAMETERS} END AS bar, round(auc, 6) AS auc, true AS timed"))
def descended_chart(t):
    """What a chart of the sweep shows: a bar per value of each parameter, with its metric and duration."""
    table = _sweep(t, _logistic, _LOGISTIC)
    bar = F.when(F.col("grid_position") < 4, F.concat(F.lit("iterations="), F.col("iterations"))).otherwise(F.concat(F.lit("step="), F.col("step")))
    return table.select(bar.alias("bar"), F.round("auc", 6).alias("auc"), (F.col("seconds") > 0).alias("timed"))


@query("e07_seconds_per_fit", f"""
WITH {_PARTED_SQL} SELECT CAST(range AS INTEGER) AS grid_position, (SELECT count(*) FROM parted WHERE bucket < 8) AS n_train, true AS timed, true AS longer_later FROM range(4)""")
def seconds_per_fit(t):
    """Duration of each fit of one sweep; a descent of more steps on the same path is never done sooner."""
    rows = _numbers(t)
    with held(rows["train"]) as train:
        n = train.count()
        done = sweeps.sweep_descents(_logistic, train, rows["validation"], evaluate.hard_label_auc, _LOGISTIC[:4])
    seconds = [trial.seconds for trial in done.trials]
    table = [(i, n, s > 0, i == 0 or s >= seconds[i - 1]) for i, s in enumerate(seconds)]
    return t.spark.createDataFrame(table, "grid_position int, n_train bigint, timed boolean, longer_later boolean")


_STUMPS = tune.settings_grid(impurity=["gini", "entropy"], maxDepth=[1], maxBins=[10, 32])


@query("g02_stump_axes", f"""
WITH base AS ({_ROWS['late']}), cuts AS (SELECT DISTINCT x AS cut FROM base),
sides AS (SELECT cut, x <= cut AS low, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM base, cuts GROUP BY 1, 2),
impure AS (SELECT cut, sum(2 * s * (n - s) / n) AS gini,
    sum(CASE WHEN s IN (0, n) THEN 0 ELSE -s * ln(s / n) - (n - s) * ln((n - s) / n) END) AS entropy FROM sides GROUP BY cut HAVING count(*) = 2),
best AS (SELECT 'gini' AS impurity, (SELECT cut FROM impure ORDER BY gini, cut LIMIT 1) AS cut UNION ALL SELECT 'entropy', (SELECT cut FROM impure ORDER BY entropy, cut LIMIT 1)),
called AS (SELECT impurity, y, CASE WHEN 2 * s > n THEN 1.0 ELSE 0.0 END AS prediction FROM best JOIN sides USING (cut) JOIN base ON low = (x <= best.cut)),
metrics AS (SELECT impurity, (1 + avg(prediction) FILTER (y = 1) - avg(prediction) FILTER (y = 0)) / 2 AS auc FROM called GROUP BY impurity)
SELECT CAST(grid_position AS INTEGER) AS grid_position, round(auc, 6) AS auc FROM (VALUES (0, 'gini'), (1, 'gini'), (2, 'entropy'), (3, 'entropy')) AS g(grid_position, impurity) JOIN metrics USING (impurity)""")
def stump_axes(t):
    rows = _rows(t, "late").select("label", "features")
    done = sweeps.sweep_trees(estimators.tree_classifier(), rows, rows, evaluate.hard_label_auc, _STUMPS, larger_is_better=True)
    return _metrics(done.table(t.spark, "auc"))


_SPLIT_SQL = "SELECT CAST(grid_position AS INTEGER) AS grid_position, (SELECT avg(CASE WHEN (l_linenumber <= cut) = (l_linenumber <= 3) THEN 1.0 ELSE 0.0 END) FROM lineitem, (SELECT max(l_linenumber) AS cut FROM lineitem WHERE l_linenumber <= 3)) AS metric"


def _separable(t):
    return _rows(t, "late").select((F.col("x") > 3).cast("double").alias("label"), "features")


@query("g05_separable_holdout", f"{_SPLIT_SQL} FROM range(4) AS r(grid_position)")
def separable_holdout(t):
    """A label that one cut of the table decides: every setting must reach the accuracy of that cut, whatever is held out."""
    tree = DecisionTreeClassifier(seed=estimators.SEED)
    grid = tune.param_grid(tree, impurity=["gini", "entropy"], maxDepth=[1, 5])
    with spread(_separable(t)) as rows:
        tuned = tune.holdout_tuner([], tree, MulticlassClassificationEvaluator(metricName="accuracy"), grid).fit(rows).stages[-1]
    return tune.tuning_table(t.spark, tuned).select("grid_position", F.round("metric", 9).alias("metric"))


@query("g04_separable_grid", """
WITH rows AS (SELECT count(DISTINCT l_linenumber <= 3) AS kinds, count(*) AS n FROM lineitem)
SELECT CAST(grid_position AS INTEGER) AS grid_position, CAST(maxDepth AS INTEGER) AS "maxDepth", CAST(maxBins AS INTEGER) AS "maxBins", CAST(kinds - 1 AS INTEGER) AS depth, CAST(2 * kinds - 1 AS INTEGER) AS nodes, n
FROM (VALUES (0, 5, 25), (1, 5, 50), (2, 10, 25), (3, 10, 50)) AS g(grid_position, maxDepth, maxBins), rows""")
def separable_grid(t):
    """A grid of parameter maps, fitted: a tree has as many leaves as the label has kinds."""
    tree = DecisionTreeClassifier(seed=estimators.SEED)
    grid = tune.param_grid(tree, maxDepth=[5, 10], maxBins=[25, 50])
    with spread(_separable(t)) as rows:
        n, fitted = rows.count(), [tree.fit(rows, params) for params in grid]
    table = [(i, m.getOrDefault("maxDepth"), m.getOrDefault("maxBins"), m.depth, m.numNodes, n) for i, m in enumerate(fitted)]
    return t.spark.createDataFrame(table, "grid_position int, maxDepth int, maxBins int, depth int, nodes int, n bigint")


_SMOOTHINGS = [1.0, 30.0, 60.0]


@query("g06_folds_of_bayes", f"""
WITH {_PARTED_SQL},
folded AS (SELECT doc_id, label, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 3 AS fold, n_chars, n_spaces, n_lines FROM pages_in),
numbers AS (
  SELECT doc_id, fold, label, 0 AS slot, n_chars AS value FROM folded UNION ALL
  SELECT doc_id, fold, label, 1, n_spaces FROM folded UNION ALL SELECT doc_id, fold, label, 2, n_lines FROM folded),
grid(grid_position, smoothing) AS (VALUES {", ".join(f"({i}, {s})" for i, s in enumerate(_SMOOTHINGS))}),
out AS (SELECT DISTINCT fold AS kept FROM folded),
sums AS (SELECT kept, label AS class, slot, sum(value) AS s FROM numbers, out WHERE fold <> kept GROUP BY kept, label, slot),
totals AS (SELECT kept, class, sum(s) AS total FROM sums GROUP BY kept, class),
classes AS (SELECT kept, label AS class, count(*) AS n FROM folded, out WHERE fold <> kept GROUP BY kept, label),
priors AS (SELECT kept, sum(n) AS n_all, count(*) AS kinds FROM classes GROUP BY kept),
model AS (
  SELECT grid_position, kept, class, slot, ln(s + smoothing) - ln(total + 3 * smoothing) AS theta, ln(n + smoothing) - ln(n_all + smoothing * kinds) AS prior
  FROM sums JOIN totals USING (kept, class) JOIN classes USING (kept, class) JOIN priors USING (kept), grid),
scores AS (
  SELECT grid_position, fold, doc_id, label, class, max(prior) + sum(theta * value) AS score
  FROM numbers JOIN model ON fold = kept AND numbers.slot = model.slot GROUP BY grid_position, fold, doc_id, label, class),
called AS (SELECT grid_position, fold, doc_id, label, arg_max(class, score) AS prediction FROM scores GROUP BY grid_position, fold, doc_id, label),
folds AS (SELECT grid_position, fold, avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM called GROUP BY grid_position, fold)
SELECT CAST(grid_position AS INTEGER) AS grid_position, round(avg(accuracy), 6) AS metric FROM folds GROUP BY grid_position""")
def folds_of_bayes(t):
    """Three-fold cross-validation of naive Bayes, with the folds given by a column."""
    docs = features.assembler(derived.NUMBERS).transform(derived.labelled_documents(t)).withColumn("fold", hash_bucket(F.col("doc_id"), 3).cast("int"))
    bayes = NaiveBayes(modelType="multinomial")
    grid = tune.param_grid(bayes, smoothing=_SMOOTHINGS)
    with spread(docs.select("label", "features", "fold")) as rows:
        tuned = tune.fold_tuner([], bayes, MulticlassClassificationEvaluator(metricName="accuracy"), grid, fold_column="fold").fit(rows).stages[-1]
    return tune.tuning_table(t.spark, tuned).select("grid_position", F.round("metric", 6).alias("metric"))
