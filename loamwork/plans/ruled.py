"""Tree models read as rule tables: agreement with the models on whole tables, leaves recounted, and scoring by rules."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from loamwork.functions import lookup
from loamwork.learning import estimators, features, rules, scoring
from loamwork.plans import derived
from loamwork.plans.models import _LINE_NUMBERS, _hour_stages
from loamwork.plans.registry import query
from loamwork.workspace import held, spread

_LINES_SQL = "SELECT l_linestatus AS part, count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM lineitem GROUP BY l_linestatus"
_DOCUMENTS_SQL = "SELECT lang AS part, count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM documents JOIN labels USING (doc_id) GROUP BY lang"
_VECTORS_SQL = "SELECT CAST(CAST(label AS DOUBLE) AS VARCHAR) AS part, count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM embeddings GROUP BY label"
_HOURS_SQL = f"WITH {derived.HOURLY_SQL} SELECT CAST(weekday AS VARCHAR) AS part, count(*) AS n, CAST(0 AS BIGINT) AS n_differ FROM hours GROUP BY weekday"


def _inputs(t, kind):
    """(rows, key, stages) of a workload: whole tables, with a part to count by."""
    if kind == "lines":
        rows = derived.sales_lines(t).withColumn("part", F.col("l_linestatus"))
        # A few lines share their number; what tells them apart is among the numbers.
        return rows, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_LINE_NUMBERS], features.mixed_features(["l_linestatus"], _LINE_NUMBERS)
    if kind == "documents":
        return derived.labelled_documents(t).withColumn("part", F.col("lang")), ["doc_id"], features.mixed_features(["lang"], derived.NUMBERS)
    if kind == "vectors":
        return derived.vectors(t).withColumn("part", F.col("label").cast("string")), ["vec_id"], []
    rows = derived.hours(t).withColumnRenamed("cnt", "label").withColumn("part", F.col("weekday").cast("string"))
    return rows, ["day_of_year", "hr", "weekday"], _hour_stages()


def _fitted(t, kind, estimator):
    """(rows with features, key, model) of a fit on the rows of a hash split; the rows are stored."""
    rows, key, stages = _inputs(t, kind)
    rows = derived.stored(t, rows, "ruled") if kind != "vectors" else rows
    train = rows.where(F.pmod(F.xxhash64(*key), F.lit(10)) < 7)
    prepared = Pipeline(stages=stages).fit(train)
    with spread(prepared.transform(train).select("label", "features")) as points:
        model = estimator.fit(points)
    return prepared.transform(rows).select(*key, "part", "label", "features"), prepared.transform(train), key, model


def _agreement(t, kind, estimator, classes, mean=False):
    """Rows per part of the table, and how many of them the rules and the model score differently."""
    rows, _, key, model = _fitted(t, kind, estimator)
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    # A row's two predictions are compared where it is, without meeting again by key.
    both = rules.predicted(model.transform(rows).select("part", "prediction", "features"), nodes, rules.depth_of(nodes), classes, mean)
    off = F.abs(F.col("prediction") - F.col("rule_prediction")) > 1e-9 * F.greatest(F.lit(1.0), F.abs("prediction"))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(off, F.lit(True))).alias("n_differ"))


@query("t01_rules_of_binary_tree", _LINES_SQL)
def rules_of_binary_tree(t):
    return _agreement(t, "lines", estimators.tree_classifier(), True)


@query("t02_rules_of_multiclass_tree", _VECTORS_SQL)
def rules_of_multiclass_tree(t):
    return _agreement(t, "vectors", estimators.tree_classifier(*estimators.COVER_TREE), True)


@query("t03_rules_of_regression_tree", _HOURS_SQL)
def rules_of_regression_tree(t):
    return _agreement(t, "hours", estimators.tree_regressor(), False)


@query("t04_rules_of_tree_stage", _DOCUMENTS_SQL)
def rules_of_tree_stage(t):
    return _agreement(t, "documents", estimators.tree_classifier("gini", 10, 14), True)


@query("t05_rules_of_regression_stage", _HOURS_SQL)
def rules_of_regression_stage(t):
    return _agreement(t, "hours", estimators.tree_regressor(5, 32), False)


@query("t06_rules_of_forest", _DOCUMENTS_SQL)
def rules_of_forest(t):
    return _agreement(t, "documents", estimators.forest_classifier(10), True)


@query("t07_rules_of_forest_regressor", _HOURS_SQL)
def rules_of_forest_regressor(t):
    return _agreement(t, "hours", estimators.forest_regressor(20), False, mean=True)


@query("t08_rules_of_boosting", _HOURS_SQL)
def rules_of_boosting(t):
    return _agreement(t, "hours", estimators.boosted_regressor(maxIter=20), False)


@query("t14_recounted_leaves", "SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS class, count(*) AS n, true AS as_counted FROM lineitem GROUP BY 1, 2")
def recounted_leaves(t):
    """A tree over all lines: rows per class summed over the leaves that a line status reaches, all equal to the model's own counts."""
    rows, _, key = _inputs(t, "lines")
    rows = derived.stored(t, rows, "ruled")
    prepared = Pipeline(stages=features.mixed_features(["l_linestatus"], _LINE_NUMBERS)).fit(rows).transform(rows)
    with spread(prepared.select("label", "features")) as points:
        model = estimators.tree_classifier().fit(points)
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    depth = rules.depth_of(nodes)
    # The lines are routed once; what they reach is a few rows a leaf.
    reached = derived.stored(t, rules.class_counts(prepared, nodes, depth, ["l_linestatus"]), "reached")
    off = rules.recounted_classes(prepared, nodes, depth, counts=reached).where("n <> model_n").count()
    return reached.groupBy("l_linestatus", "class").agg(F.sum("n").alias("n")).withColumn("as_counted", F.lit(off == 0))


@query("t14_recounted_means", f"WITH {derived.HOURLY_SQL} SELECT count(*) AS n, CAST(sum(cnt) AS BIGINT) AS total, true AS same_counts, true AS same_means FROM hours")
def recounted_means(t):
    """A regression tree over all hours: rows and sums of all leaves, and whether each leaf's count and mean are the model's."""
    rows, _, _ = _inputs(t, "hours")
    rows = derived.stored(t, rows, "ruled")
    prepared = Pipeline(stages=_hour_stages()).fit(rows).transform(rows)
    with spread(prepared.select("label", "features")) as points:
        model = estimators.tree_regressor().fit(points)
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    leaves = rules.recounted(prepared, nodes, rules.depth_of(nodes))
    return leaves.agg(
        F.sum("n").alias("n"), F.round(F.sum(F.col("n") * F.col("mean"))).cast("bigint").alias("total"), F.bool_and(F.col("n") == F.col("model_n")).alias("same_counts"),
        F.bool_and(F.abs(F.col("mean") - F.col("model_mean")) < 1e-9 * F.greatest(F.lit(1.0), F.abs("mean"))).alias("same_means"),
    )


@query("t14_leaf_conditions")
def leaf_conditions(t):
    """The bounds that the path to each leaf sets on each feature, of a tree over labelled documents."""
    _, _, _, model = _fitted(t, "documents", estimators.tree_classifier("gini", 5, 14))
    return rules.conditions(derived.stored(t, rules.node_table(t.spark, model), "nodes"))


@query("v01_scored_by_rules", "SELECT doc_id, true AS same FROM documents JOIN labels USING (doc_id)")
def scored_by_rules(t):
    rows, _, key, model = _fitted(t, "documents", estimators.tree_classifier("gini", 10, 14))
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    ruled = rules.scored(rows, nodes, rules.depth_of(nodes), key, True)
    return model.transform(rows).join(ruled, key, "left").select("doc_id", F.coalesce(F.col("prediction") == F.col("rule_prediction"), F.lit(False)).alias("same"))


@query("v02_unlabelled_by_rules", "SELECT doc_id, true AS same FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def unlabelled_by_rules(t):
    """Descriptions of rows no label covers, by rules and by the model."""
    docs = derived.stored(t, derived.labelled_documents(t), "documents")
    with held(docs):
        stages = Pipeline(stages=features.mixed_features(["lang"], derived.NUMBERS)).fit(docs)
    with spread(stages.transform(docs).select("label", "features")) as points:
        model = estimators.tree_classifier().fit(points)
    rows = stages.transform(derived.stored(t, derived.unlabelled_documents(t), "unlabelled"))
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    ruled = rules.scored(rows, nodes, rules.depth_of(nodes), ["doc_id"], True).withColumnRenamed("rule_prediction", "prediction")
    named = scoring.described(ruled, lookup.PAGE_TYPES, ["doc_id"]).withColumnRenamed("description", "by_rules")
    whole = scoring.described(model.transform(rows), lookup.PAGE_TYPES, ["doc_id"])
    return whole.join(named.select("doc_id", "by_rules"), "doc_id", "left").select("doc_id", F.coalesce(F.col("description") == F.col("by_rules"), F.lit(False)).alias("same"))


@query("v03_marked_by_rules", """
SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, true AS adds_up FROM embeddings GROUP BY label""")
def marked_by_rules(t):
    """Vectors per class, and whether those marked right and wrong by the rules are those that the model marks."""
    rows, _, key, model = _fitted(t, "vectors", estimators.tree_classifier(*estimators.COVER_TREE))
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    ruled = rules.scored(rows, nodes, rules.depth_of(nodes), key, True).withColumnRenamed("rule_prediction", "prediction")
    marked = scoring.marked(ruled.join(rows.select(*key, "label"), key)).select(*key, F.col("correct").alias("by_rules"))
    both = scoring.marked(model.transform(rows)).join(marked, key, "left")
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("correct") == F.col("by_rules"), F.lit(False))).alias("adds_up"))


@query("v04_report_by_rules", f"WITH {derived.HOURLY_SQL} SELECT day_of_year, hr, weekday, CAST(cnt AS BIGINT) AS actual, true AS same FROM hours")
def report_by_rules(t):
    """Every hour's whole-number prediction by rules and by the model."""
    rows, _, key, model = _fitted(t, "hours", estimators.tree_regressor())
    nodes = derived.stored(t, rules.node_table(t.spark, model), "nodes")
    ruled = rules.scored(rows, nodes, rules.depth_of(nodes), key, False).withColumnRenamed("rule_prediction", "prediction")
    by_rules = scoring.regression_report(ruled.join(rows.select(*key, "label"), key), "label", key).select(*key, F.col("predicted").alias("ruled"))
    whole = scoring.regression_report(model.transform(rows), "label", key)
    return whole.join(by_rules, key, "left").select(*key, F.col("actual").cast("bigint").alias("actual"), F.coalesce(F.col("predicted") == F.col("ruled"), F.lit(False)).alias("same"))
