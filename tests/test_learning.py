"""Properties of training, scoring, evaluation and tuning."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from loamwork.functions.lookup import PAGE_TYPES
from loamwork.learning import estimators, evaluate, features, recommend, rules, scoring, serving, sweeps, tune
from loamwork.sources.models import save_model
from loamwork.workspace import fresh_path, spread


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, "abc"[i % 3], float(i % 10), float((i * 7) % 13), float((i % 10) > 4)) for i in range(300)]
    return spark.createDataFrame(rows, "id int, kind string, a double, b double, label double").cache()


@pytest.fixture(scope="module")
def points(labelled):
    stages = Pipeline(stages=features.mixed_features(["kind"], ["a", "b"], "standard"))
    return stages.fit(labelled).transform(labelled).select("id", "label", "features").cache()


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(u, i, float(1 + (u * 3 + i * 5) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double").cache()


@pytest.fixture(scope="module")
def factors(ratings):
    return recommend.train(ratings, rank=3, iterations=5, blocks=2)


def test_unseen_category_has_its_own_slot(spark, labelled):
    model = Pipeline(stages=features.mixed_features(["kind"], ["a"])).fit(labelled)
    row = spark.createDataFrame([("zzz", 1.0)], "kind string, a double")
    assert model.transform(row).first().features == Vectors.dense(0, 0, 0, 1, 1)


def test_scaler_uses_the_sample_deviation(labelled):
    stages = [features.assembler(["a", "b"], "assembled"), features.scaler(center=True)]
    rows = Pipeline(stages=stages).fit(labelled).transform(labelled).select("features").collect()
    table = np.array([r.features.toArray() for r in rows])
    assert np.allclose(table.mean(axis=0), 0) and np.allclose(table.std(axis=0, ddof=1), 1)


def test_tree_respects_depth_and_learns(points):
    model = estimators.tree_classifier("gini", 3, 32).fit(points)
    assert model.depth <= 3
    assert evaluate.one_number(evaluate.accuracy(model.transform(points))) == 1.0


def test_rules_and_importances(spark, points):
    model = estimators.tree_classifier("gini", 3, 32).fit(points)
    rules = [r.line for r in estimators.rule_lines(spark, model).orderBy("line_number").collect()]
    assert "\n".join(rules) == model.toDebugString.rstrip("\n")
    assert sum(r.importance for r in estimators.importances(spark, model).collect()) == pytest.approx(1.0)


def descended(rows, kind, iterations, step, regularisation):
    """Full-batch gradient descent by hand, in plain arithmetic."""
    weights = [0.0] * len(rows[0][1])
    for t in range(1, iterations + 1):
        gradient = [0.0] * len(weights)
        for label, x in rows:
            margin = sum(a * b for a, b in zip(weights, x))
            sign = 2 * label - 1
            pull = 1 / (1 + math.exp(-margin)) - label if kind == "logistic" else -sign if sign * margin < 1 else 0.0
            gradient = [g + pull * v for g, v in zip(gradient, x)]
        rate = step / t**0.5
        weights = [w * (1 - rate * regularisation) - rate * g / len(rows) for w, g in zip(weights, gradient)]
    return weights


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_gradient_descent_equals_plain_arithmetic(points, kind):
    rows = [(float(r.label), list(r.features.toArray())) for r in points.collect()]
    if kind == "logistic":
        model, by_hand = estimators.sgd_logistic(points, 6, 1.0, 1.0), descended(rows, kind, 6, 1.0, 0.0)
    else:
        model, by_hand = estimators.sgd_svm(points, 6, 1.0, 0.01), descended(rows, kind, 6, 1.0, 0.01)
    assert model.weights == pytest.approx(by_hand, rel=1e-6, abs=1e-9)
    ours = {r.id: r.prediction for r in estimators.sgd_predict(model, points).collect()}
    assert ours == {r.id: float(sum(a * b for a, b in zip(by_hand, r.features.toArray())) > 0) for r in points.collect()}


def test_logistic_and_svm_separate(points):
    for estimator in (estimators.logistic(30, 0.001), estimators.linear_svm(30, 0.001)):
        assert evaluate.score_auc(estimator.fit(points).transform(points)) > 0.99


def test_regressors_beat_the_mean(labelled):
    rows = features.assembler(["a", "b"]).transform(labelled).withColumn("y", F.col("a") * 3 + F.col("b"))
    spread = rows.agg(F.stddev_pop("y")).first()[0]
    for estimator in (
        estimators.tree_regressor(label="y"), estimators.forest_regressor(5, label="y"),
        estimators.boosted_regressor(label="y", maxIter=3),
    ):
        assert evaluate.one_number(evaluate.rmse(estimator.fit(rows).transform(rows), "y")) < spread / 2


def test_chain_survives_saving(labelled):
    model = Pipeline(
        stages=[*features.mixed_features(["kind"], ["a", "b"]), estimators.forest_classifier(3)]
    ).fit(labelled)
    path = fresh_path(labelled.sparkSession, "test")
    save_model(model, path)
    again = PipelineModel.load(path)
    assert model.transform(labelled).select("id", "prediction").exceptAll(
        again.transform(labelled).select("id", "prediction")
    ).count() == 0


def test_hard_label_auc_equals_the_evaluator(spark):
    rows = [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 9
    scored = spark.createDataFrame(rows, "label double, prediction double")
    built_in = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(scored)
    assert evaluate.one_number(evaluate.hard_label_auc(scored)) == pytest.approx(built_in)


def test_score_auc_with_ties_equals_pair_counting(spark):
    rng = np.random.default_rng(3)
    labels, scores = rng.integers(0, 2, 200), rng.integers(0, 12, 200) / 4
    pos, neg = scores[labels == 1], scores[labels == 0]
    expected = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    scored = spark.createDataFrame([(float(l), float(s)) for l, s in zip(labels, scores)], "label double, s double")
    assert evaluate.score_auc(scored, score="s") == pytest.approx(expected)


def test_coverage_rmse_divides_by_all_pairs(spark):
    actual = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 1, 3.0), (9, 9, 5.0)], "u int, i int, rating double")
    predicted = spark.createDataFrame([(1, 1, 3.0), (2, 1, 1.0)], "u int, i int, prediction double")
    value = evaluate.one_number(evaluate.coverage_rmse(predicted, actual, ["u", "i"]))
    assert value == pytest.approx(((1 + 4) / 4) ** 0.5)
    nothing = predicted.filter("u > 5")
    assert evaluate.one_number(evaluate.coverage_rmse(nothing, actual, ["u", "i"])) == 0.0


def test_scoring_reports(spark):
    scored = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0)], "id int, label double, prediction double")
    assert [r.correct for r in scoring.marked(scored).orderBy("id").collect()] == [True, False]
    assert {r.description for r in scoring.described(scored, PAGE_TYPES, ["id"]).collect()} == {PAGE_TYPES[0]}
    hours = spark.createDataFrame([(16.0, 16.9), (5.0, 9.2)], "cnt double, prediction double")
    report = scoring.regression_report(hours, "cnt", []).orderBy("actual").collect()
    assert [tuple(r) for r in report] == [(9, 5.0, False, 4.0), (16, 16.0, True, 0.0)]


def test_decoded_hours(spark):
    row = spark.createDataFrame(
        [(1.0, 5.0, 0.0, 6.0, 1.0, 3.0, 0.5, 0.5, 0.5, 0.5, 7.0)],
        "season double, hr double, holiday double, weekday double, workingday double, weathersit double, "
        "temp double, atemp double, hum double, windspeed double, cnt double",
    )
    assert tuple(scoring.decoded_hours(row).first()) == (
        "春", 5.0, "非假日", "日", "工作日", "小雨", 20.5, 25.0, 50.0, 33.5, 7.0,
    )


def test_factors_satisfy_the_normal_equations(ratings, factors):
    users = {r.id: np.array(r.features) for r in factors.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in factors.itemFactors.collect()}
    # Each iteration solves the items first, then the users against them.
    for user, solved in users.items():
        seen = [(items[r.item_id], r.rating) for r in ratings.filter(F.col("user_id") == user).collect()]
        q, r = np.array([i for i, _ in seen]), np.array([x for _, x in seen])
        expected = np.linalg.solve(q.T @ q + 0.1 * len(seen) * np.eye(3), q.T @ r)
        assert np.allclose(solved, expected, atol=1e-3)


def test_training_is_repeatable(ratings, factors):
    again = recommend.train(ratings, rank=3, iterations=5, blocks=2)
    first = {r.id: r.features for r in factors.userFactors.collect()}
    second = {r.id: r.features for r in again.userFactors.collect()}
    assert first.keys() == second.keys()
    assert all(np.allclose(first[k], second[k], atol=1e-4) for k in first)


def test_top_lists_match_brute_force(spark, factors):
    users = {r.id: np.array(r.features) for r in factors.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in factors.itemFactors.collect()}
    rows = recommend.top_items(factors, 4).collect()
    assert len(rows) == 4 * len(users)
    for user, factor in users.items():
        listed = sorted((r for r in rows if r.user_id == user), key=lambda r: r.place)
        scores = sorted((float(factor @ i) for i in items.values()), reverse=True)[:4]
        assert np.allclose([r.score for r in listed], scores, atol=1e-4)
    one = recommend.top_users(factors, 3, spark.createDataFrame([(2,)], "item_id int")).collect()
    assert [r.place for r in sorted(one, key=lambda r: -r.score)] == [1, 2, 3]


def test_unknown_ids_get_no_prediction(spark, factors):
    asked = spark.createDataFrame([(1, 1), (999, 1), (1, 999)], "user_id int, item_id int")
    assert [(r.user_id, r.item_id) for r in recommend.predict_pairs(factors, asked).collect()] == [(1, 1)]


def test_ids_beyond_int_are_indexed(spark):
    rows = [(2**40 + u, f"item{i}", float(u + i)) for u in range(3) for i in range(2)]
    wide = spark.createDataFrame(rows, "user_id bigint, item_id string, rating double")
    dense = recommend.with_int_ids(wide, "user_id", "item_id")
    assert dict(dense.dtypes) == {"user_id": "int", "item_id": "int", "rating": "double"}
    assert sorted(tuple(r) for r in dense.select("user_id", "item_id", "rating").collect()) == [
        (u, i, float(u + i)) for u in range(3) for i in range(2)
    ]


def test_serving_both_directions(spark, factors):
    path = fresh_path(spark, "test")
    save_model(factors, path)
    titles = spark.createDataFrame([(i, f"title {i}") for i in range(20)], "item_id int, title string")
    items = recommend.serve(spark, path, "U", 3, 5, titles).collect()
    assert len(items) == 5 and all(r.title == f"title {r.item_id}" for r in items)
    users = recommend.serve(spark, path, "M", 4, 5, titles).collect()
    assert len(users) == 5 and {r.title for r in users} == {"title 4"}
    with pytest.raises(ValueError):
        recommend.serve(spark, path, "X", 1, 1, titles)


def test_grids():
    assert tune.settings_grid(a=[1, 2], b=["x"]) == [{"a": 1, "b": "x"}, {"a": 2, "b": "x"}]
    assert tune.one_axis("a", [1, 2], b=0) == [{"b": 0, "a": 1}, {"b": 0, "a": 2}]
    assert len(tune.settings_grid(**tune.TREE_AXES)) == 72


def test_sweep_keeps_grid_order_and_the_earlier_best():
    done = tune.sweep(lambda x: x, lambda m: float(abs(m - 2)), tune.settings_grid(x=[0, 1, 3, 9]), False)
    assert [t.settings["x"] for t in done.trials] == [0, 1, 3, 9]
    assert done.best.settings == {"x": 1}


def test_estimator_sweep(spark, points):
    def accuracy(scored):
        return evaluate.one_number(evaluate.accuracy(scored))

    train, validation = points.filter("id % 4 <> 0"), points.filter("id % 4 = 0")
    done = tune.sweep_estimator(
        estimators.tree_classifier("gini"), train, validation, accuracy,
        tune.one_axis("maxDepth", [0, 1, 4], maxBins=16), larger_is_better=True,
    )
    table = done.table(spark, "accuracy").orderBy("grid_position").collect()
    assert [r.maxDepth for r in table] == ["0", "1", "4"]
    assert done.best.model.depth <= 4 and sum(r.is_best for r in table) == 1
    assert max(r.accuracy for r in table) == done.best.metric
    assert all(r.seconds > 0 for r in table)


@pytest.mark.parametrize("make", [tune.holdout_tuner, tune.fold_tuner])
def test_tuners(spark, labelled, make):
    tree = estimators.tree_classifier("gini")
    grid = tune.param_grid(tree, maxDepth=[1, 3], maxBins=[8, 16])
    tuned = make(features.mixed_features(["kind"], ["a", "b"]), tree, BinaryClassificationEvaluator(), grid)
    table = tune.tuning_table(spark, tuned.fit(labelled).stages[-1]).collect()
    assert len(table) == 4 and sum(r.is_best for r in table) == 1
    assert max(r.metric for r in table) == next(r.metric for r in table if r.is_best)


def test_folds_from_a_column(spark, points):
    tree = estimators.tree_classifier("gini")
    folded = points.withColumn("fold", F.col("id") % 3)
    tuner = tune.fold_tuner(
        [], tree, BinaryClassificationEvaluator(), tune.param_grid(tree, maxDepth=[1, 2]), fold_column="fold"
    )
    assert len(tuner.fit(folded).stages[-1].avgMetrics) == 2


@pytest.mark.parametrize("kind", ["tree", "forest", "regressor", "forest_regressor", "boosted"])
def test_rule_table_scores_as_the_model(spark, points, kind):
    estimator, classes, mean = {
        "tree": (estimators.tree_classifier("gini", 6, 32), True, False), "forest": (estimators.forest_classifier(7), True, False),
        "regressor": (estimators.tree_regressor(6, 32), False, False), "forest_regressor": (estimators.forest_regressor(5), False, True),
        "boosted": (estimators.boosted_regressor(maxIter=4), False, False),
    }[kind]
    noisy = points.withColumn("label", F.when(F.col("id") % 11 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = estimator.fit(noisy)
    nodes = rules.node_table(spark, model).cache()
    depth = rules.depth_of(nodes)
    trees = getattr(model, "trees", [model])
    assert nodes.count() == sum(t.numNodes for t in trees) and depth == max(t.depth for t in trees)
    found = {r.id: r.rule_prediction for r in rules.scored(points, nodes, depth, ["id"], classes, mean).collect()}
    assert all(found[r.id] == pytest.approx(r.prediction, abs=1e-9) for r in model.transform(points).collect())
    if kind == "regressor":
        assert all(r.n == r.model_n and r["mean"] == pytest.approx(r.model_mean) for r in rules.recounted(noisy, nodes, depth).collect())
    if kind == "tree":
        counted = rules.recounted_classes(noisy, nodes, depth).collect()
        assert counted and all(r.n == r.model_n for r in counted) and sum(r.n for r in counted) == 300
        # A row meets all conditions of its leaf and of no other.
        bounds = {}
        for r in rules.conditions(nodes).collect():
            bounds.setdefault(r.leaf, []).append(r)
        for r in rules.routed(points, nodes, depth).collect():
            met = [leaf for leaf, cs in bounds.items() if all((c.above is None or r.features[c.slot] > c.above) and (c.up_to is None or r.features[c.slot] <= c.up_to) for c in cs)]
            assert met == [r.leaf]


def test_rule_table_with_categories(spark):
    rows = [(i, float(i % 7), float(i % 7 in (1, 4, 6)) + (i % 3) / 10) for i in range(210)]
    frame = spark.createDataFrame(rows, "id int, a double, label double")
    ready = Pipeline(stages=[features.assembler(["a"], "assembled"), features.category_slots(10)]).fit(frame).transform(frame)
    model = estimators.tree_regressor(4, 16).fit(ready)
    nodes = rules.node_table(spark, model).cache()
    assert nodes.where("categories IS NOT NULL").count() > 0
    found = {r.id: r.rule_prediction for r in rules.scored(ready, nodes, rules.depth_of(nodes), ["id"], False).collect()}
    assert all(found[r.id] == pytest.approx(r.prediction) for r in model.transform(ready).collect())
    leaf = {r.id: r.leaf for r in rules.routed(ready, nodes, 4).collect()}
    among = {r.leaf: (r.among, r.outside) for r in rules.conditions(nodes).collect()}
    assert all((among[leaf[i]][0] is None or a in among[leaf[i]][0]) and a not in (among[leaf[i]][1] or []) for i, a, _ in rows)


def test_a_leaf_alone_is_a_rule_table(spark, points):
    nodes = rules.node_table(spark, estimators.tree_classifier("gini", 0, 32).fit(points))
    assert nodes.count() == 1 and rules.depth_of(nodes) == 0 and rules.conditions(nodes).count() == 0
    assert rules.scored(points, nodes, 0, ["id"], True).select("rule_prediction").distinct().count() == 1


def test_one_growth_equals_a_fit_per_setting(spark, points):
    noisy = points.withColumn("label", F.when(F.pmod(F.hash("id"), F.lit(5)) == 0, 1 - F.col("label")).otherwise(F.col("label"))).cache()
    seen, unseen = noisy.where("id % 3 > 0"), noisy.where("id % 3 = 0")
    grid = tune.settings_grid(impurity=["gini", "entropy"], maxDepth=[1, 2, 3, 5, 10, 20], maxBins=[3, 10, 32])
    done = sweeps.sweep_trees(estimators.tree_classifier(), seen, unseen, evaluate.hard_label_auc, grid, larger_is_better=True)
    assert [t.settings for t in done.trials] == grid and all(t.seconds > 0 for t in done.trials)
    with spread(seen) as rows:
        for trial in done.trials:
            model = estimators.tree_classifier(trial.settings["impurity"], trial.settings["maxDepth"], trial.settings["maxBins"]).fit(rows)
            assert trial.metric == pytest.approx(evaluate.one_number(evaluate.hard_label_auc(model.transform(unseen)))), trial.settings
    nodes, depth = done.best.model
    served = rules.routed(unseen, nodes, depth).withColumnRenamed("value", "prediction")
    assert evaluate.one_number(evaluate.hard_label_auc(served)) == pytest.approx(done.best.metric)


def test_folds_of_a_regression_tree(spark, points):
    folded = points.withColumn("label", F.col("label") * 3 + F.col("id") % 7).withColumn("fold", F.col("id") % 3)
    grid = tune.settings_grid(maxDepth=[1, 3, 8], maxBins=[8, 32])
    done, per_fold = sweeps.sweep_folds(estimators.tree_regressor(), folded, evaluate.rmse, grid, larger_is_better=False)
    table = {(r.position, r.fold): r.rmse for r in per_fold.collect()}
    with spread(folded) as rows:
        for i, p in enumerate(grid):
            for k in range(3):
                model = estimators.tree_regressor(p["maxDepth"], p["maxBins"]).fit(rows.where(F.col("fold") != k))
                assert table[i, k] == pytest.approx(evaluate.one_number(evaluate.rmse(model.transform(rows.where(F.col("fold") == k)))))
            assert done.trials[i].metric == pytest.approx(sum(table[i, k] for k in range(3)) / 3)


def test_descents_in_step_equal_single_ones(points):
    grid = [estimators.logistic_descent(n, s, f) for n in (0, 2, 5) for s in (0.5, 2.0) for f in (0.5, 1.0)] + [estimators.hinge_descent(4, 1.0, 0.1)]
    ended = []
    together = estimators.descend(points, grid, ended.append)
    for descent, model in zip(grid, together):
        assert model.weights == pytest.approx(estimators.descend(points, [descent])[0].weights, abs=1e-12)
    assert [grid[i].iterations for i in ended] == sorted(d.iterations for d in grid if d.iterations)
    calls = estimators.linear_predictions(together, points, ["id"]).collect()
    for k in (5, 12):
        alone = {r.id: r.prediction for r in estimators.sgd_predict(together[k], points).collect()}
        assert {r.id: r.prediction for r in calls if r.position == k} == alone


@pytest.mark.parametrize("blocks, piece", [(7, 2), (64, 128), (1000, 1)])
def test_top_lists_equal_all_products(spark, blocks, piece):
    rng = np.random.default_rng(6)
    factors = rng.standard_normal((400, 5)).astype(np.float32) * rng.lognormal(0, 1.2, (400, 1)).astype(np.float32)
    factors[10:14] = factors[9]
    factors[20] = 0
    asked = rng.standard_normal((60, 5)).astype(np.float32)
    asked[3] = 0
    def frame(x):
        return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<float>")

    found = {}
    for r in serving.top_lists(frame(asked), frame(factors), 9, blocks, piece).collect():
        found.setdefault(r.id, {})[r.place] = (r.other, r.score, r.visited)
    scores = asked.astype(float) @ factors.astype(float).T
    for i in range(60):
        order = sorted(range(400), key=lambda j: (-round(scores[i, j], 9), j))[:9]
        assert [found[i][p][1] for p in range(1, 10)] == pytest.approx([scores[i, j] for j in order], abs=1e-6)
        if i != 3:
            assert [found[i][p][0] for p in range(1, 10)] == order
    visited = [found[i][1][2] for i in range(60)]
    assert max(visited) <= -(-400 // blocks) and (blocks > 64 or min(visited) < -(-400 // blocks))
    few = serving.top_lists(frame(asked[:2]), frame(factors[:4]), 9, blocks, piece).collect()
    assert sorted((r.id, r.place) for r in few) == [(i, p) for i in range(2) for p in range(1, 5)]
    assert serving.top_lists(frame(asked).limit(0), frame(factors), 9).count() == 0
