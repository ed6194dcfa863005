"""Learners whose result follows from SQL: trees of one split on a column of few values, and facts about trained models.

A split of a 0/1 label by Gini impurity is the split of least squared error, so one statement covers regression and both
kinds of classification; leaves hold means and class shares.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from loamwork.functions import lookup
from loamwork.learning import estimators, features, recommend, scoring
from loamwork.operators import splits
from loamwork.plans import derived, recommending
from loamwork.plans.registry import query
from loamwork.workspace import spread

_ROWS = {
    "late": "SELECT CAST(l_linenumber AS BIGINT) AS x, CASE WHEN l_linenumber + l_quantity % 5 > 5 THEN 1 ELSE 0 END AS y FROM lineitem",
    "quantity": "SELECT CAST(l_linenumber AS BIGINT) AS x, l_quantity AS y FROM lineitem",
}
_CLASSES = "SELECT CAST(l_linenumber AS BIGINT) AS x, CASE WHEN l_linenumber + l_quantity % 5 < 4 THEN 0 WHEN l_linenumber + l_quantity % 5 < 7 THEN 1 ELSE 2 END AS y FROM lineitem"


def _split_sql(rows: str) -> str:
    return f"""
WITH base AS ({rows}), cuts AS (SELECT DISTINCT x AS cut FROM base),
sides AS (SELECT cut, x <= cut AS low, count(*) AS n, sum(CAST(y AS DOUBLE)) AS s, sum(CAST(y AS DOUBLE) * y) AS q FROM base, cuts GROUP BY 1, 2),
errors AS (SELECT cut, sum(q - s * s / n) AS error FROM sides GROUP BY cut HAVING count(*) = 2),
best AS (SELECT cut FROM errors ORDER BY error, cut LIMIT 1)"""


def _leaf_sql(rows: str) -> str:
    return f"""{_split_sql(rows)}
SELECT x, round(s / n, 6) AS leaf FROM (SELECT DISTINCT x FROM base) v, best b JOIN sides d ON d.cut = b.cut WHERE d.low = (x <= b.cut)"""


_MULTI_SQL = f"""
WITH base AS ({_CLASSES}), cuts AS (SELECT DISTINCT x AS cut FROM base),
classes AS (SELECT cut, x <= cut AS low, y, count(*) AS s FROM base, cuts GROUP BY 1, 2, 3),
sides AS (SELECT cut, low, sum(s) AS n, sum(s) - sum(CAST(s AS DOUBLE) * s) / sum(s) AS gini FROM classes GROUP BY 1, 2),
best AS (SELECT cut FROM sides GROUP BY cut HAVING count(*) = 2 ORDER BY sum(gini), cut LIMIT 1)
SELECT x, round(max(CASE WHEN c.y = 2 THEN CAST(c.s AS DOUBLE) ELSE 0 END) / max(d.n), 6) AS leaf
FROM (SELECT DISTINCT x FROM base) v, best b JOIN sides d ON d.cut = b.cut JOIN classes c ON c.cut = d.cut AND c.low = d.low
WHERE d.low = (x <= b.cut) GROUP BY x"""


def _rows(t, label: str) -> DataFrame:
    mark = F.col("l_linenumber") + F.col("l_quantity") % 5
    # Leaves with the same majority are merged by the learner, so these labels depend on the column.
    labels = {
        "late": (mark > 5).cast("double"), "quantity": F.col("l_quantity").cast("double"),
        "class": F.when(mark < 4, 0.0).when(mark < 7, 1.0).otherwise(2.0),
    }
    rows = t.lineitem.select(F.col("l_linenumber").cast("bigint").alias("x"), labels[label].alias("label"))
    return features.assembler(["x"]).transform(rows)


def _stump(t, label: str, estimator):
    rows = _rows(t, label)
    with spread(rows) as train:
        # Plain numbers are made distinct before they become vectors, by hashing and not by sorting all rows.
        return estimator.fit(train), features.assembler(["x"]).transform(rows.select("x").distinct())


def _leaves(t, label: str, estimator, share: int | None = None) -> DataFrame:
    model, values = _stump(t, label, estimator)
    leaf = F.col("prediction") if share is None else vector_to_array("probability")[share]
    return model.transform(values).select("x", F.round(leaf, 6).alias("leaf"))


_ONE = {"maxDepth": 1, "seed": estimators.SEED}


@query("t01_binary_stump", _leaf_sql(_ROWS["late"]))
def binary_stump(t):
    return _leaves(t, "late", DecisionTreeClassifier(**_ONE), 1)


@query("t02_multi_stump", _MULTI_SQL)
def multi_stump(t):
    return _leaves(t, "class", DecisionTreeClassifier(**_ONE), 2)


@query("t03_regression_stump", _leaf_sql(_ROWS["quantity"]))
def regression_stump(t):
    return _leaves(t, "quantity", DecisionTreeRegressor(**_ONE))


@query("t04_pipeline_stump", _leaf_sql(_ROWS["late"]))
def pipeline_stump(t):
    rows = _rows(t, "late").drop("features")
    with spread(rows) as train:
        model = Pipeline(stages=[features.assembler(["x"]), DecisionTreeClassifier(**_ONE)]).fit(train)
    scored = model.transform(rows.dropDuplicates(["x"]))
    return scored.select("x", F.round(vector_to_array("probability")[1], 6).alias("leaf"))


@query("t05_pipeline_regression_stump", _leaf_sql(_ROWS["quantity"]))
def pipeline_regression_stump(t):
    rows = _rows(t, "quantity").drop("features")
    with spread(rows) as train:
        model = Pipeline(stages=[features.assembler(["x"]), DecisionTreeRegressor(**_ONE)]).fit(train)
    return model.transform(rows.dropDuplicates(["x"])).select("x", F.round("prediction", 6).alias("leaf"))


@query("t06_forest_of_one", _leaf_sql(_ROWS["late"]))
def forest_of_one(t):
    return _leaves(t, "late", RandomForestClassifier(numTrees=1, bootstrap=False, **_ONE), 1)


@query("t07_forest_regressor_of_one", _leaf_sql(_ROWS["quantity"]))
def forest_regressor_of_one(t):
    return _leaves(t, "quantity", RandomForestRegressor(numTrees=1, bootstrap=False, **_ONE))


@query("t08_boosting_of_one_round", _leaf_sql(_ROWS["quantity"]))
def boosting_of_one_round(t):
    return _leaves(t, "quantity", GBTRegressor(maxIter=1, **_ONE))


@query("t14_stump_rule", f"{_split_sql(_ROWS['quantity'])} SELECT CAST(cut + 0.5 AS DOUBLE) AS threshold FROM best")
def stump_rule(t):
    """The threshold as the rule dump prints it."""
    model, _ = _stump(t, "quantity", DecisionTreeRegressor(**_ONE))
    lines = estimators.rule_lines(t.spark, model)
    found = lines.select(F.regexp_extract("line", r"<= ([0-9.]+)", 1).alias("text")).where("text <> ''")
    return found.select(F.col("text").cast("double").alias("threshold"))


_SCORED_SQL = f"""{_split_sql(_ROWS['late'])},
called AS (SELECT x, CASE WHEN 2 * s > n THEN 1 ELSE 0 END AS prediction, s / n AS share
  FROM (SELECT DISTINCT x FROM base) v, best b JOIN sides d ON d.cut = b.cut WHERE d.low = (x <= b.cut))"""


@query("v01_stump_scores", f"{_SCORED_SQL} SELECT l_orderkey, l_linenumber, CAST(prediction AS DOUBLE) AS prediction, round(share, 6) AS share FROM lineitem JOIN called ON x = l_linenumber")
def stump_scores(t):
    model, _ = _stump(t, "late", DecisionTreeClassifier(**_ONE))
    lines = features.assembler(["l_linenumber"]).transform(t.lineitem)
    return model.transform(lines).select("l_orderkey", "l_linenumber", "prediction", F.round(vector_to_array("probability")[1], 6).alias("share"))


@query("v02_stump_descriptions", f"{_SCORED_SQL} SELECT l_orderkey, CAST(prediction AS DOUBLE) AS prediction, CASE prediction WHEN 0 THEN '{lookup.PAGE_TYPES[0]}' ELSE '{lookup.PAGE_TYPES[1]}' END AS description FROM lineitem JOIN called ON x = l_linenumber")
def stump_descriptions(t):
    model, _ = _stump(t, "late", DecisionTreeClassifier(**_ONE))
    lines = features.assembler(["l_linenumber"]).transform(t.lineitem)
    return scoring.described(model.transform(lines), lookup.PAGE_TYPES, ["l_orderkey"])


@query("v04_stump_errors", f"{_leaf_sql(_ROWS['quantity']).replace('SELECT x, round(s / n, 6) AS leaf', ', leaves AS (SELECT x, s / n AS leaf')}) SELECT l_orderkey, l_linenumber, CAST(trunc(leaf) AS BIGINT) AS guess, round(abs(leaf - l_quantity), 6) AS error FROM lineitem JOIN leaves ON x = l_linenumber")
def stump_errors(t):
    model, _ = _stump(t, "quantity", DecisionTreeRegressor(**_ONE))
    lines = features.assembler(["l_linenumber"]).transform(t.lineitem)
    return model.transform(lines).select(
        "l_orderkey", "l_linenumber", F.col("prediction").cast("bigint").alias("guess"), F.round(F.abs(F.col("prediction") - F.col("l_quantity")), 6).alias("error")
    )


@query("t13_stage_names", """
SELECT * FROM (VALUES (0, 'StringIndexerModel'), (1, 'OneHotEncoderModel'), (2, 'VectorAssembler'), (3, 'DecisionTreeClassificationModel')) AS s(stage, kind),
(SELECT count(*) AS n_scored FROM documents JOIN labels USING (doc_id))""")
def stage_names(t):
    docs = derived.labelled_documents(t)
    stages = [*features.mixed_features(["lang"], derived.NUMBERS), estimators.tree_classifier("gini", 3, 14)]
    with spread(docs) as rows:
        model = Pipeline(stages=stages).fit(rows)
    names = t.spark.createDataFrame([(i, type(stage).__name__) for i, stage in enumerate(model.stages)], "stage int, kind string")
    return names.withColumn("n_scored", model.transform(docs).agg(F.count("prediction")).scalar())


@query("u05_random_split_once", "SELECT doc_id, CAST(1 AS BIGINT) AS n FROM documents")
def random_split_once(t):
    """Each document is in exactly one of the seeded splits."""
    parts = splits.random_split(t.documents.select("doc_id"), [0.4, 0.6], seed=0)
    return parts[0].unionAll(parts[1]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def _served_sql(key: str, other: str) -> str:
    return f"""
WITH {derived.RATINGS_SQL}
SELECT CAST({key} AS INTEGER) AS {key}, least(10, (SELECT count(DISTINCT {other}) FROM ratings)) AS n, true AS in_order, true AS is_product
FROM ratings WHERE {key} % 20 = 0 GROUP BY {key}"""


def _served(model, lists: DataFrame, key: str, other: str) -> DataFrame:
    """Per asked id: how many places, whether scores fall from place to place, and equal the products of the factors."""
    sides = {"user_id": model.userFactors, "item_id": model.itemFactors}
    own = sides[key].select(F.col("id").alias(key), F.col("features").alias("own"))
    theirs = sides[other].select(F.col("id").alias(other), F.col("features").alias("theirs"))
    product = F.aggregate(F.zip_with("own", "theirs", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, p: s + p)
    joined = lists.join(own, key).join(theirs, other).withColumn("near", F.abs(product - F.col("score")) < 1e-3)
    places = F.sort_array(F.collect_list(F.struct("place", "score")))
    falling = F.forall(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.col("p")[i]["score"] <= F.col("p")[i - 1]["score"])
    return joined.groupBy(key).agg(F.count(F.lit(1)).alias("n"), places.alias("p"), F.bool_and("near").alias("is_product")).select(
        key, "n", falling.alias("in_order"), "is_product"
    )


@query("v07_places_of_items", _served_sql("user_id", "item_id"))
def places_of_items(t):
    ratings = recommending.ratings_of(t)
    model = recommend.train(ratings, iterations=10)
    return _served(model, recommend.top_items(model, 10, recommending.asked(ratings, "user_id")), "user_id", "item_id")


@query("v08_places_of_users", _served_sql("item_id", "user_id"))
def places_of_users(t):
    ratings = recommending.ratings_of(t)
    model = recommend.train(ratings, iterations=10)
    return _served(model, recommend.top_users(model, 10, recommending.asked(ratings, "item_id")), "item_id", "user_id")


@query("t12_normal_equations", f"WITH {derived.RATINGS_SQL} SELECT CAST(user_id AS INTEGER) AS user_id, count(*) AS n, true AS solved FROM ratings GROUP BY user_id")
def normal_equations(t):
    """Per item in the last half-step of a fit: (sum u u' + lambda n I) v = sum r u. Users are solved last."""
    ratings = recommending.ratings_of(t)
    model = recommend.train(ratings, iterations=10, regularisation=0.1)
    # Factors cross the shuffle as floats, and the ratings are looked up in them without being sorted.
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_u")).hint("shuffle_hash")
    items = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("_v")).hint("shuffle_hash")
    dot = F.aggregate(F.zip_with("u", "v", lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    met = ratings.select("user_id", "item_id", "rating").join(items, "item_id").join(users, "user_id")
    seen = met.withColumns({"u": F.col("_u").cast("array<double>"), "v": F.col("_v").cast("array<double>")}).withColumn("gap", dot - F.col("rating"))
    # Slot by slot: sum of gap * v, plus lambda * n * u, is near zero for solved users.
    slots = seen.select("user_id", "u", F.posexplode(F.transform("v", lambda x: x * F.col("gap"))).alias("slot", "pull"))
    sums = slots.groupBy("user_id", "slot").agg(F.sum("pull").alias("pull"), F.count(F.lit(1)).alias("n"), F.first("u").alias("u"))
    rest = F.abs(F.col("pull") + 0.1 * F.col("n") * F.col("u")[F.col("slot")]) / F.col("n")
    return sums.groupBy("user_id").agg(F.max("n").alias("n"), (F.max(rest) < 1e-2).alias("solved"))
