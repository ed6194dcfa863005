"""Evaluation (E). Metrics with an SQL twin score rows by a fixed expression instead of a trained model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from loamwork.learning import estimators, evaluate, features
from loamwork.operators.splits import hash_split
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.workspace import held


@query("e01_hard_label_auc", f"""
WITH {derived.LINES_SQL}, p AS (SELECT label, CASE WHEN score > 0.7 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)
SELECT round((1 + avg(prediction) FILTER (label = 1) - avg(prediction) FILTER (label = 0)) / 2, 6) AS auc FROM p""")
def hard_label_auc(t):
    scored = derived.scored_lines(t).withColumn("prediction", (F.col("score") > 0.7).cast("double"))
    return evaluate.hard_label_auc(scored).select(F.round("auc", 6).alias("auc"))


@query("e02_score_auc", f"""
WITH {derived.LINES_SQL}, by_score AS (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY score),
running AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM by_score)
SELECT round(sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc FROM running""")
def score_auc(t):
    auc = evaluate.score_auc(derived.scored_lines(t), score="score")
    return t.spark.createDataFrame([(round(auc, 6),)], "auc double")


@query("e03_accuracy", """
SELECT round(avg(CASE WHEN label = (list_position(embedding, list_max(embedding)) - 1) % 10 THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM embeddings""")
def accuracy(t):
    guess = (F.array_position("embedding", F.array_max("embedding")) - 1) % 10
    return evaluate.accuracy(t.embeddings.withColumn("prediction", guess)).select(F.round("accuracy", 6).alias("accuracy"))


@query("e04_rmse", "SELECT round(sqrt(avg(pow(l_quantity * 1500 - l_extendedprice, 2.0))), 4) AS rmse FROM lineitem")
def rmse(t):
    scored = t.lineitem.withColumn("prediction", F.col("l_quantity") * 1500)
    return evaluate.rmse(scored, "l_extendedprice").select(F.round("rmse", 4).alias("rmse"))


@query("e05_coverage_rmse", f"""
WITH {derived.RATINGS_SQL}, predicted AS (
  SELECT user_id, item_id, CAST(p_size AS DOUBLE) / 10 AS prediction FROM ratings JOIN part ON item_id = p_partkey WHERE p_type <> 'ECONOMY')
SELECT round(sqrt(sum(pow(prediction - rating, 2.0)) / (SELECT count(*) FROM ratings)), 6) AS rmse
FROM ratings JOIN predicted USING (user_id, item_id)""")
def coverage_rmse(t):
    actual = derived.stored_ratings(t)
    known = t.part.filter("p_type <> 'ECONOMY'").select(
        F.col("p_partkey").alias("item_id"), (F.col("p_size").cast("double") / 10).alias("prediction")
    )
    predicted = actual.join(known, "item_id")
    return evaluate.coverage_rmse(predicted, actual, ["user_id", "item_id"]).select(F.round("rmse", 6).alias("rmse"))


@query("e06_by_split", f"""
WITH {derived.LINES_SQL}, p AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'train' ELSE 'test' END AS split, label, CASE WHEN score > 0.7 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)
SELECT split, round((1 + avg(prediction) FILTER (label = 1) - avg(prediction) FILTER (label = 0)) / 2, 6) AS auc FROM p GROUP BY split""")
def by_split(t):
    scored = derived.scored_lines(t).withColumn("prediction", (F.col("score") > 0.7).cast("double"))
    named = scored.withColumn("split", F.when(F.col("l_linestatus") == "F", "train").otherwise("test"))
    return evaluate.hard_label_auc(named, by=["split"]).withColumn("auc", F.round("auc", 6))


@query("e06_model_by_split")
def model_by_split(t):
    split = hash_split(F.col("doc_id"), {"train": 8, "validation": 1, "test": 1})
    documents = derived.stored(t, derived.labelled_documents(t).withColumn("split", split), "documents")
    stages = [*features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier()]
    with held(documents.filter("split = 'train'")) as train:
        model = Pipeline(stages=stages).fit(train)
    return evaluate.hard_label_auc(model.transform(documents), by=["split"])
