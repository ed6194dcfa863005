"""Sweeps that share work: trees grown once for all depths, descents taken in step, and all models judged in one pass.

A greedy tree of depth 25 holds every shallower tree of the same impurity and bins as its top. So one tree is grown per pair
of these, and its rule table tells what each shallower tree would have predicted. The predictions of all models of a sweep are
rows of one frame, and one grouped aggregate gives all metrics: the number of evaluation jobs doesn't depend on the grid.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from time import perf_counter

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.learning import estimators, rules
from loamwork.learning.tune import Sweep, Trial, sweep
from loamwork.workspace import TRAINING_PARTITIONS, fresh_path, held, spread

#: A metric of a frame of labels and predictions: (frame, by) to (by, metric).
Metric = Callable[..., DataFrame]


def judged(predictions: DataFrame, metric: Metric, by: Sequence[str] = ("position",)) -> list[float]:
    """The metric of every model, in order of position, from (position, label, prediction) rows: one job."""
    found = metric(predictions, by=list(by))
    name = next(c for c in found.columns if c not in by)
    return [float(r[name]) for r in found.orderBy(*by).collect()]


def grown(spark: SparkSession, train: DataFrame, estimator, grid: Sequence[Mapping], parallelism: int = 4) -> tuple[DataFrame, int, dict, dict]:
    """(nodes, depth, numbers, seconds): the rule tables of one tree per setting without its maxDepth, as deep as the grid asks.

    ``numbers`` gives the tree of a setting's other values, ``seconds`` how long it took. The caller keeps ``train`` cached.
    """
    deepest: dict[tuple, int] = {}
    for point in grid:
        rest = _rest(point)
        deepest[rest] = max(deepest.get(rest, 0), point["maxDepth"])
    fits = [{**dict(rest), "maxDepth": depth} for rest, depth in deepest.items()]

    def fit(**settings):
        deep = estimator.copy({estimator.getParam(k): v for k, v in {**settings, "cacheNodeIds": settings["maxDepth"] > 15}.items()})
        return rules.node_table(spark, deep.fit(train), list(deepest).index(_rest(settings)))

    # Sweep keeps one model at a time; here the tables of all of them are wanted.
    tables: dict[int, DataFrame] = {}

    def kept(**settings):
        nodes = fit(**settings)
        tables[list(deepest).index(_rest(settings))] = nodes
        return nodes

    done = sweep(kept, lambda _: 0.0, fits, larger_is_better=True, parallelism=parallelism)
    seconds = {_rest(trial.settings): trial.seconds for trial in done.trials}
    nodes = reduce(DataFrame.unionByName, [tables[i] for i in sorted(tables)])
    return nodes, max(deepest.values()), {rest: i for i, rest in enumerate(deepest)}, seconds


def _settings(point: Mapping) -> tuple:
    return tuple(sorted(point.items()))


def _rest(point: Mapping) -> tuple:
    return tuple(sorted((k, v) for k, v in point.items() if k != "maxDepth"))


def tree_predictions(rows: DataFrame, nodes: DataFrame, depth: int, numbers: Mapping, grid: Sequence[Mapping], keep: Sequence[str]) -> DataFrame:
    """(kept columns, position, prediction) of every setting of a grid, routed through the deep trees at once."""
    depths = sorted({p["maxDepth"] for p in grid})
    found = rules.descended(rows.select(*keep, "features"), nodes, depth, watch=depths)
    cuts: dict[int, list] = {}
    for position, point in enumerate(grid):
        cuts.setdefault(numbers[_rest(point)], []).append((position, depths.index(point["maxDepth"])))
    # For each tree, which settings it stands for and at which of the watched depths.
    listed = [F.when(F.col("tree") == tree, F.array(*[F.struct(F.lit(p).alias("position"), F.col("at")[d].alias("prediction")) for p, d in at])) for tree, at in cuts.items()]
    return found.select(*keep, F.explode(F.coalesce(*listed)).alias("_p")).select(*keep, "_p.position", "_p.prediction")


def sweep_trees(
    estimator, train: DataFrame, validation: DataFrame, metric: Metric, grid: Sequence[Mapping], larger_is_better: bool, parallelism: int = 4, label: str = "label",
    least: int = TRAINING_PARTITIONS,
) -> Sweep:
    """Sweep a single-tree estimator over settings with maxDepth; equal to a fit per setting.

    Every partition sends its counts of all features, bins and classes for every node that is split. Where these, and not the rows, are most of
    the work, as in deep trees over wide vectors, let there be ``least`` 1 partition and fits side by side instead.

    The best trial's ``model`` is (nodes, depth): the rule table of its tree, to be routed to its depth. Seconds are those of the
    shared growth, and of the one evaluation for all.
    """
    spark = train.sparkSession
    with spread(train, least=least) as rows, held(validation):
        nodes, depth, numbers, seconds = grown(spark, rows, estimator, grid, parallelism)
        with held(nodes):
            began = perf_counter()
            metrics = judged(tree_predictions(validation, nodes, depth, numbers, grid, [label]), metric)
            judging = perf_counter() - began
    trials = [Trial(i, dict(p), m, seconds[_rest(p)] + judging, None) for i, (p, m) in enumerate(zip(grid, metrics))]
    done = Sweep(trials, larger_is_better)
    best = done.best
    best.model = (nodes.where(F.col("tree") == numbers[_rest(best.settings)]), best.settings["maxDepth"])
    return done


def sweep_descents(
    kind: Callable[..., estimators.Descent], train: DataFrame, validation: DataFrame, metric: Metric, grid: Sequence[Mapping], larger_is_better: bool = True
) -> Sweep:
    """Sweep a gradient descent: as many fitting jobs as the longest has iterations, and one evaluation.

    A trial's seconds run from the common start to its last step, and include the evaluation.
    """
    descents = [kind(**{k: v for k, v in point.items()}) for point in grid]
    ended: dict[int, float] = {}
    with spread(train.select("label", "features")) as rows, held(validation):
        began = perf_counter()
        models = estimators.descend(rows, descents, lambda i: ended.setdefault(i, perf_counter() - began))
        judging = perf_counter()
        metrics = judged(estimators.linear_predictions(models, validation, ["label"]), metric)
        judging = perf_counter() - judging
    trials = [Trial(i, dict(p), m, ended.get(i, 0.0) + judging, model) for i, (p, m, model) in enumerate(zip(grid, metrics, models))]
    return Sweep(trials, larger_is_better)


def sweep_folds(
    estimator, folds: DataFrame, metric: Metric, grid: Sequence[Mapping], larger_is_better: bool, fold: str = "fold", label: str = "label", parallelism: int = 4
) -> tuple[Sweep, DataFrame]:
    """(sweep, per_fold) of k-fold cross-validation by a fold column: one growth per fold and setting without depth.

    ``per_fold`` has (position, fold, metric) rows; a trial's metric is their mean. All folds are judged in one aggregate.
    """
    spark = folds.sparkSession
    numbers = [r[0] for r in folds.select(fold).distinct().orderBy(fold).collect()]
    parts, seconds = [], {}
    with spread(folds) as rows:
        for number in numbers:
            seen, unseen = rows.where(F.col(fold) != number), rows.where(F.col(fold) == number)
            nodes, depth, trees, took = grown(spark, seen, estimator, grid, parallelism)
            for rest, s in took.items():
                seconds[rest] = seconds.get(rest, 0.0) + s
            parts.append(tree_predictions(unseen, nodes, depth, trees, grid, [fold, label]))
        found = metric(reduce(DataFrame.unionByName, parts), by=["position", fold])
        name = next(c for c in found.columns if c not in ("position", fold))
        table = sorted((r["position"], r[fold], float(r[name])) for r in found.collect())
    per_fold = spark.createDataFrame(table, f"position int, {fold} int, {name} double")
    means = [sum(m for p, _, m in table if p == i) / len(numbers) for i in range(len(grid))]
    return Sweep([Trial(i, dict(p), means[i], seconds[_rest(p)], None) for i, p in enumerate(grid)], larger_is_better), per_fold


def factor_predictions(models: Sequence, pairs: DataFrame, rating: str = "rating") -> DataFrame:
    """(position, rating, prediction) of every pair that a model knows both sides of; the factors of all models are joined at once."""
    def stacked(side: str, key: str, name: str) -> DataFrame:
        parts = [getattr(m, side).select(F.lit(i).alias("position"), F.col("id").alias(key), F.col("features").alias(name)) for i, m in enumerate(models)]
        return reduce(DataFrame.unionByName, parts)

    user, item = models[0].getUserCol(), models[0].getItemCol()
    product = F.aggregate(F.zip_with("_u", "_v", lambda a, b: a * b), F.lit(0.0).cast("float"), lambda s, p: s + p)
    met = pairs.select(user, item, rating).join(stacked("userFactors", user, "_u"), user).join(stacked("itemFactors", item, "_v"), ["position", item])
    return met.select("position", rating, product.cast("double").alias("prediction"))


def sweep_factors(estimator, train: DataFrame, validation: DataFrame, grid: Sequence[Mapping], rating: str = "rating", parallelism: int = 4) -> tuple[Sweep, DataFrame]:
    """(sweep, counts) of a factoriser by root mean squared error over all pairs, predicted or not; all models are judged in one job.

    ``counts`` has (position, n, n_predicted): the pairs to predict and those that the model knows. Models are saved as soon as they
    are fitted, and read from there: a trial's model keeps no shuffle files of its training on disk.
    """
    spark = train.sparkSession
    # Equal settings, which two axes share, are fitted once.
    first = {_settings(p): i for i, p in reversed(list(enumerate(grid)))}
    paths: dict[int, str] = {}

    def fit(position, **settings):
        paths[position] = fresh_path(spark, "factor-model")
        # A checkpoint in every iteration lets go of its shuffle files, so that those of one iteration lie on disk and not of five.
        params = {**settings, "checkpointInterval": 1}
        estimator.copy({estimator.getParam(k): v for k, v in params.items()}).fit(rows).write().save(paths[position])
        # What a fit leaves behind, its shuffle files and cached factors, is deleted when the driver collects it, which may take long.
        gc.collect()
        spark.sparkContext._jvm.System.gc()

    with held(train) as rows, held(validation):
        fits = sweep(fit, lambda _: 0.0, [{"position": i, **grid[i]} for i in sorted(first.values())], False, parallelism)
        loaded = {i: ALSModel.load(path) for i, path in paths.items()}
        models = [loaded[first[_settings(p)]] for p in grid]
        seconds = {t.settings["position"]: t.seconds for t in fits.trials}
        n = validation.count()
        gap = F.col("prediction") - F.col(rating)
        found = factor_predictions(models, validation, rating).groupBy("position").agg(F.sum(gap * gap).alias("squares"), F.count(F.lit(1)).alias("n")).collect()
    sums = {r["position"]: (r["squares"], r["n"]) for r in found}
    trials = [Trial(i, dict(p), (sums.get(i, (0.0, 0))[0] / max(n, 1)) ** 0.5, seconds[first[_settings(p)]], models[i]) for i, p in enumerate(grid)]
    counts = spark.createDataFrame([(i, n, sums.get(i, (0.0, 0))[1]) for i in range(len(grid))], "position int, n bigint, n_predicted bigint")
    return Sweep(trials, False), counts
