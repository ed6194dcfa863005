"""Queries and helpers whose work must not hang on one setting, one task or kept results."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from loamwork.learning import estimators, evaluate, features, recommend, rules, serving, sweeps, tune
from loamwork.llm import decontaminate
from loamwork.plans import QUERIES
from loamwork.workspace import PARTITION_ROWS, TRAINING_PARTITIONS, dealt, spread


def test_regression_sweep_runs_with_fewer_bins_than_hours(spark, tmp_path):
    events = spark.range(2000).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 1800).alias("ts"), (F.col("id") % 17).alias("user_id"), (F.col("id") % 23).cast("double").alias("value")
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    rows = QUERIES["g03_full_sweep_regression"](spark, str(tmp_path)).collect()
    assert [r.grid_position for r in rows] == list(range(36)) and sum(r.is_best for r in rows) == 1
    assert {r.maxBins for r in rows} == {"3", "5", "10", "50", "100", "200"} and all(r.rmse >= 0 for r in rows)


def test_factor_sweep_keeps_saved_models_and_fits_equal_settings_once(spark):
    ratings = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3], "user_id int, item_id int, rating float")
    grid = [{"rank": 2, "maxIter": 3, "regParam": 0.1}, {"rank": 3, "maxIter": 3, "regParam": 0.1}, {"rank": 2, "maxIter": 3, "regParam": 0.1}]
    done, counts = sweeps.sweep_factors(recommend.factoriser(), ratings.where("user_id % 7 > 0"), ratings.where("item_id % 4 = 0"), grid)
    assert [t.model.rank for t in done.trials] == [2, 3, 2] and [t.settings for t in done.trials] == grid
    assert all(t.model.userFactors.inputFiles() and t.model.itemFactors.inputFiles() for t in done.trials)
    assert done.trials[0].model is done.trials[2].model and done.trials[0].metric == done.trials[2].metric
    single = recommend.train(ratings.where("user_id % 7 > 0"), rank=3, iterations=3)
    pairs = ratings.where("item_id % 4 = 0")
    found = evaluate.one_number(evaluate.coverage_rmse(recommend.predict_pairs(single, pairs), pairs, ["user_id", "item_id"]))
    assert abs(done.trials[1].metric - found) < 1e-4
    assert all(r.n == pairs.count() and r.n_predicted == pairs.where("user_id % 7 > 0").count() for r in counts.collect())


def test_equal_rows_are_dealt_over_partitions(spark):
    frame = spark.range(0, 130_000, 1, 5).select(F.when(F.col("id") < 90_000, 7).otherwise(F.col("id")).alias("x"), F.lit(1.0).alias("y"))

    def dealt_rows(df):
        with spread(df) as rows:
            return [(r.p, r.x, r["count"]) for r in rows.groupBy(F.spark_partition_id().alias("p"), "x").count().orderBy("p", "x").collect()]

    found = dealt_rows(frame)
    assert sum(n for *_, n in found) == 130_000 and sum(n for _, x, n in found if x == 7) == 90_000
    assert len({p for p, x, _ in found if x == 7}) > 1
    assert found == dealt_rows(frame.repartition(3, "x"))


def test_partitions_grow_with_the_rows(spark):
    assert dealt(spark.range(0, 1000)).rdd.getNumPartitions() == TRAINING_PARTITIONS
    assert dealt(spark.range(0, PARTITION_ROWS * TRAINING_PARTITIONS + 1)).rdd.getNumPartitions() == TRAINING_PARTITIONS + 1


def test_all_products_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(serving, "ASKED_ROWS", 16)
    monkeypatch.setattr(serving, "MET_ROWS", 50)
    rng = np.random.default_rng(3)
    factors, asked = rng.standard_normal((300, 4)).astype(np.float32), rng.standard_normal((70, 4)).astype(np.float32)

    def frame(x):
        return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<float>").coalesce(1)

    lists = serving.all_products(frame(asked), frame(factors), 6)
    found = {(r.id, r.place): (r.other, r.score) for r in lists.collect()}
    scores = asked.astype(float) @ factors.astype(float).T
    assert len(found) == 70 * 6
    for i in range(70):
        order = np.argsort(-scores[i])[:6]
        assert [found[i, p][0] for p in range(1, 7)] == order.tolist()
        assert np.allclose([found[i, p][1] for p in range(1, 7)], scores[i, order])
    searched = {(r.id, r.place): r.other for r in serving.top_lists(frame(asked), frame(factors), 6, 32, 4).collect()}
    assert searched == {k: v[0] for k, v in found.items()}
    assert serving.all_products(frame(asked[:3]), frame(factors[:2]), 6).count() == 6
    assert serving.all_products(frame(asked).limit(0), frame(factors), 6).count() == 0


def test_directions_are_fitted_on_all_documents(spark):
    rows = 100_000 * decontaminate.PASSAGE
    docs = spark.range(9).select(F.col("id").alias("doc_id"), F.col("id").alias("tie"), F.expr(f"unhex(repeat(concat('0', id + 1, '000000'), {rows}))").alias("words"))
    idf, directions = decontaminate.factorise(docs.repartition(3))
    assert np.abs(directions[1:10]).sum(axis=1).min() > 0 and np.allclose(idf[1:10], idf[1])


@pytest.mark.parametrize("trees", [1, 3])
def test_rows_descend_in_one_step_or_by_joins_alike(spark, monkeypatch, trees):
    points = spark.range(600).select("id", (F.col("id") % 5).cast("double").alias("kind"), F.sin("id").alias("x"), (F.col("id") % 5 * 3 + F.col("id") % 2 + F.cos(F.col("id") * 2)).alias("label"))
    points = Pipeline(stages=[features.assembler(["kind", "x"], "assembled"), features.category_slots(5)]).fit(points).transform(points).select("id", "label", "features").cache()
    model = (estimators.tree_regressor(5, 16) if trees == 1 else estimators.forest_regressor(trees)).fit(points)
    nodes = rules.node_table(spark, model).cache()
    depth = rules.depth_of(nodes)
    assert nodes.where("categories IS NOT NULL").count()

    def places():
        return sorted(map(tuple, rules.descended(points.select("id", "features"), nodes, depth, watch=[0, 2, 9]).drop("features").collect()))

    at_once = places()
    assert "Join" not in rules.descended(points, nodes, depth)._jdf.queryExecution().toString()
    monkeypatch.setattr(rules, "HELD_NODES", 0)
    assert len(at_once) == 600 * trees and at_once == places()
    monkeypatch.undo()
    # Rows that come twice stay two rows, each with its answer.
    twice = model.transform(points.unionAll(points)).select("id", "prediction", "features")
    found = rules.predicted(twice, nodes, depth, False, mean=trees > 1).collect()
    assert len(found) == 1200 and all(r.prediction == pytest.approx(r.rule_prediction) for r in found)


def test_leaves_are_recounted_from_one_routing(spark):
    points = spark.range(400).select(F.concat(F.lit("g"), F.col("id") % 3).alias("part"), F.col("id").cast("double").alias("x"), (F.col("id") % 7 < 3).cast("double").alias("label"))
    points = features.assembler(["x"]).transform(points).cache()
    nodes = rules.node_table(spark, estimators.tree_classifier("gini", 6, 32).fit(points)).cache()
    depth = rules.depth_of(nodes)
    counts = rules.class_counts(points, nodes, depth, ["part"]).cache()
    assert counts.agg(F.sum("n")).first()[0] == 400
    found = rules.recounted_classes(points, nodes, depth, counts=counts)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rules.recounted_classes(points, nodes, depth).collect()))
    assert found.where("n <> model_n").count() == 0


def test_deep_sweeps_may_ask_for_few_partitions(spark):
    points = spark.range(300).select(F.cos("id").alias("x"), F.sin(F.col("id") * 3).alias("y"), (F.col("id") % 3).cast("double").alias("label"))
    points = features.assembler(["x", "y"]).transform(points).select("label", "features").cache()
    assert dealt(points, least=1).rdd.getNumPartitions() == 1
    grid = [{"impurity": "gini", "maxDepth": depth, "maxBins": 10} for depth in (2, 6)]
    many, few = (sweeps.sweep_trees(estimators.tree_classifier(), points, points, evaluate.accuracy, grid, True, **most) for most in ({}, {"parallelism": 2, "least": 1}))
    assert [t.metric for t in many.trials] == [t.metric for t in few.trials]


def test_gathered_trees_are_grown_over_few_partitions(spark, monkeypatch):
    """One partition of counts instead of sixteen, with the held-out rows and the metrics that sixteen partitions gave."""
    points = spark.range(400).select(F.cos("id").alias("x"), F.sin(F.col("id") * 3).alias("y"), (F.col("id") % 3).cast("double").alias("label"))
    points = features.assembler(["x", "y"]).transform(points).select("label", "features")
    seen, fit = [], DecisionTreeClassifier._fit

    def counted(self, dataset):
        seen.append(dataset.rdd.getNumPartitions())
        return fit(self, dataset)

    monkeypatch.setattr(DecisionTreeClassifier, "_fit", counted)
    with spread(points) as rows:
        found = []
        for tree in (estimators.tree_classifier("gini"), estimators.gathered_tree("gini")):
            grid = tune.param_grid(tree, maxDepth=[3, 8], maxBins=[10, 20])
            found.append(tune.holdout_tuner([], tree, MulticlassClassificationEvaluator(metricName="accuracy"), grid).fit(rows).stages[-1])
    assert seen == [16] * 5 + [1] * 5
    assert found[0].validationMetrics == found[1].validationMetrics
    assert found[0].bestModel.toDebugString.split("\n")[1:] == found[1].bestModel.toDebugString.split("\n")[1:]


def test_blocks_of_a_factoriser_follow_from_the_ratings(spark, monkeypatch):
    ratings = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(40) for i in range(20) if (u + i) % 3], "user_id int, item_id int, rating float")
    rows = ratings.count()
    assert recommend.rating_blocks(ratings) == recommend.BLOCKS
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", rows // 13)
    found, named, least = (
        {r.id: r.features for r in recommend.train(ratings, rank=3, iterations=2, **blocks).userFactors.collect()} for blocks in ({}, {"blocks": -(-rows // (rows // 13))}, {"blocks": recommend.BLOCKS})
    )
    assert len(found) == 40 and found == named != least


def test_no_product_in_reach_is_left_out():
    rng = np.random.default_rng(5)
    own, met = rng.standard_normal((30, 6)).astype(np.float32), rng.standard_normal((400, 6)).astype(np.float32)
    # Products that differ by less than floats can tell, and factors whose products are no floats.
    met[200:300] = met[100] * (1 + 1e-7 * np.arange(100, dtype=np.float32)[:, None])
    for scale in (1.0, 1e-25, 1e25):
        asked, others = own * np.float32(scale), met * np.float32(scale)
        exact = asked.astype(float) @ others.astype(float).T
        row, column = serving.reached(asked, others, np.full(30, -np.inf), 10)
        worst = np.sort(exact, axis=1)[:, -10]
        assert set(zip(*np.nonzero(exact >= worst[:, None]))) <= set(zip(row, column))
        again = set(zip(*serving.reached(asked, others, worst, 0)))
        assert set(zip(*np.nonzero(exact >= worst[:, None]))) <= again
        assert scale != 1.0 or len(again) < 30 * 400 / 4


def test_all_products_in_slices_of_a_block(spark, monkeypatch):
    rng = np.random.default_rng(4)
    factors, asked = rng.integers(-2, 3, (500, 3)).astype(np.float32), rng.integers(-2, 3, (60, 3)).astype(np.float32)
    frame = lambda x: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, features array<float>").coalesce(1)
    monkeypatch.setattr(serving, "MET_ROWS", 100)
    monkeypatch.setattr(serving, "SLICE_ROWS", 16)
    # Equal products go by id, whatever the slice and the order of blocks.
    found = {(r.id, r.place): (r.other, r.score) for r in serving.all_products(frame(asked), frame(factors), 7).collect()}
    scores = asked.astype(float) @ factors.astype(float).T
    order = [sorted(range(500), key=lambda j: (-scores[i, j], j))[:7] for i in range(60)]
    assert found == {(i, p + 1): (j, scores[i, j]) for i in range(60) for p, j in enumerate(order[i])}
