"""Model training (T) and batch scoring (V01 to V04).

Each query fits on training rows and returns the scored rows of every split it does not train on, or of the
whole table where the query is about scoring.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loamwork.functions import lookup
from loamwork.learning import estimators, features, scoring
from loamwork.operators.splits import split_frames
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.workspace import spread


def _fit(train, *stages):
    with spread(train) as rows:
        return Pipeline(stages=list(stages)).fit(rows)


def _documents(t, estimator, scale=None):
    parts = derived.document_splits(t)
    model = _fit(parts["train"], *features.mixed_features(["lang"], derived.NUMBERS, scale), estimator)
    scored = model.transform(parts["test"].unionAll(parts["validation"]))
    return scored.select("doc_id", "label", "prediction")


_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(t, estimator):
    row = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    parts = split_frames(derived.sales_lines(t), row, {"train": 7, "test": 3})
    model = _fit(parts["train"], *features.mixed_features(["l_linestatus"], _LINE_NUMBERS), estimator)
    return model.transform(parts["test"]).select("l_orderkey", "l_partkey", "label", "prediction")


def _vectors(t, estimator):
    parts = derived.vector_splits(t)
    with spread(parts["train"]) as train:
        model = estimator.fit(train)
    return model.transform(parts["test"]).select("vec_id", "label", "prediction")


def _hour_stages():
    return [features.assembler(derived.HOUR_FEATURES, "assembled"), features.category_slots(24)]


def _hours(t, estimator):
    parts = derived.hour_splits(t)
    model = _fit(parts["train"], *_hour_stages(), estimator)
    return model.transform(parts["test"]).select("day_of_year", "hr", "cnt", "prediction")


@query("t01_binary_tree")
def binary_tree(t):
    return _lines(t, estimators.tree_classifier())


@query("t02_multiclass_tree")
def multiclass_tree(t):
    return _vectors(t, estimators.tree_classifier(*estimators.COVER_TREE))


@query("t03_regression_tree")
def regression_tree(t):
    return _hours(t, estimators.tree_regressor(label="cnt"))


@query("t04_tree_stage_binary")
def tree_stage_binary(t):
    return _documents(t, estimators.tree_classifier("gini", 10, 14))


@query("t04_tree_stage_multiclass")
def tree_stage_multiclass(t):
    return _vectors(t, estimators.tree_classifier("gini", 5, 20))


@query("t05_tree_stage_regression")
def tree_stage_regression(t):
    return _hours(t, estimators.tree_regressor(5, 32, label="cnt"))


@query("t06_forest_classifier")
def forest_classifier(t):
    return _documents(t, estimators.forest_classifier(10))


@query("t07_forest_regressor")
def forest_regressor(t):
    return _hours(t, estimators.forest_regressor(20, label="cnt"))


@query("t08_boosted_regressor")
def boosted_regressor(t):
    return _hours(t, estimators.boosted_regressor(label="cnt", maxIter=20))


@query("t09_logistic")
def logistic(t):
    return _documents(t, estimators.logistic(), scale="standard")


@query("t10_linear_svm")
def linear_svm(t):
    return _documents(t, estimators.linear_svm(), scale="standard")


def _sgd(t, train):
    docs = derived.document_splits(t)
    stages = _fit(docs["train"], *features.mixed_features(["lang"], derived.NUMBERS, "standard"))
    with spread(stages.transform(docs["train"]).select("label", "features")) as rows:
        model = train(rows)
    held_out = docs["test"].unionAll(docs["validation"])
    return estimators.sgd_predict(model, stages.transform(held_out)).select("doc_id", "label", "prediction")


@query("t09_logistic_sgd")
def logistic_sgd(t):
    return _sgd(t, estimators.sgd_logistic)


@query("t10_svm_sgd")
def svm_sgd(t):
    return _sgd(t, estimators.sgd_svm)


@query("t11_naive_bayes", f"""
WITH {derived.BINARY_SQL},
numbers AS (
  SELECT label, 0 AS slot, n_chars AS value FROM pages_in UNION ALL
  SELECT label, 1, n_spaces FROM pages_in UNION ALL SELECT label, 2, n_lines FROM pages_in),
sums AS (SELECT label, slot, sum(value) AS s FROM numbers GROUP BY label, slot),
totals AS (SELECT label, sum(s) AS total FROM sums GROUP BY label),
classes AS (SELECT label, count(*) AS n FROM pages_in GROUP BY label)
SELECT label, CAST(slot AS INTEGER) AS slot, round(ln(s + 60.0) - ln(total + 60.0 * 3), 6) AS theta,
       round(ln(n + 60.0) - ln((SELECT count(*) FROM pages_in) + 60.0 * (SELECT count(*) FROM classes)), 6) AS prior
FROM sums JOIN totals USING (label) JOIN classes USING (label)""")
def naive_bayes(t):
    docs = features.assembler(derived.NUMBERS).transform(derived.labelled_documents(t))
    with spread(docs.select("label", "features")) as rows:
        model = estimators.naive_bayes(60.0).fit(rows)
    weights = [
        (float(c), slot, float(model.theta[c, slot]), float(model.pi[c]))
        for c in range(model.theta.numRows) for slot in range(model.theta.numCols)
    ]
    table = t.spark.createDataFrame(weights, "label double, slot int, theta double, prior double")
    return table.withColumns({c: F.round(c, 6) for c in ("theta", "prior")})


@query("t13_stage_chain")
def stage_chain(t):
    docs = derived.labelled_documents(t)
    model = _fit(docs, *features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier("gini", 10, 14))
    names = [(i, type(stage).__name__) for i, stage in enumerate(model.stages)]
    stages = t.spark.createDataFrame(names, "stage int, kind string")
    scored = model.transform(docs).agg(F.count("prediction").alias("n"))
    return stages.withColumn("n_scored", scored.scalar())


@query("t14_rules")
def rules(t):
    parts = derived.document_splits(t)
    model = _fit(
        parts["train"], *features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier("gini", 5, 14)
    )
    return estimators.rule_lines(t.spark, model.stages[-1])


@query("t14_importances")
def importances(t):
    parts = derived.hour_splits(t)
    model = _fit(parts["train"], *_hour_stages(), estimators.forest_regressor(10, label="cnt"))
    return estimators.importances(t.spark, model.stages[-1])


@query("v01_batch_score")
def batch_score(t):
    parts = derived.document_splits(t)
    model = _fit(
        parts["train"], *features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier("gini", 10, 14)
    )
    return model.transform(derived.labelled_documents(t)).select(
        "doc_id", "label", vector_to_array("rawPrediction").alias("raw"),
        vector_to_array("probability").alias("probability"), "prediction",
    )


@query("v02_score_unlabelled")
def score_unlabelled(t):
    docs = derived.labelled_documents(t)
    model = _fit(docs, *features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier())
    return scoring.described(model.transform(derived.unlabelled_documents(t)), lookup.PAGE_TYPES, ["doc_id"])


@query("v03_score_marked")
def score_marked(t):
    return scoring.marked(_vectors(t, estimators.tree_classifier(*estimators.COVER_TREE)))


@query("v04_regression_report")
def regression_report(t):
    parts = derived.hour_splits(t)
    model = _fit(parts["train"], *_hour_stages(), estimators.tree_regressor(label="cnt"))
    scored = model.transform(derived.hours(t))
    weekday = lookup.decode(F.col("weekday"), lookup.WEEKDAYS).alias("weekday")
    return scoring.regression_report(scored, "cnt", ["day_of_year", "hr", weekday])
