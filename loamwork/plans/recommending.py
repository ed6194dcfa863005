"""Factor model training (T12) and serving (V05 to V10)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from loamwork.learning import recommend
from loamwork.learning.serving import BLOCK_ROWS, PIECE, all_products, top_lists
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.sources.models import save_model
from loamwork.workspace import cut_lineage, fresh_path


def ratings_of(t):
    return recommend.with_int_ids(derived.stored_ratings(t), "user_id", "item_id")


def _model(ratings, iterations=10):
    return recommend.train(ratings, iterations=iterations)


def _most_active(ratings):
    """The user with the most ratings and the item with the most ratings; ties go to the smaller id."""
    found = []
    for column in ("user_id", "item_id"):
        counts = ratings.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        found.append(counts.orderBy(F.desc("n"), column).first()[0])
    return found


@query("t12_factors")
def factors(t):
    model = _model(ratings_of(t), iterations=20)
    users = model.userFactors.select(F.lit("user").alias("side"), "id", "features")
    return users.unionAll(model.itemFactors.select(F.lit("item").alias("side"), "id", "features"))


@query("v05_predict_one")
def predict_one(t):
    ratings = ratings_of(t)
    user, item = _most_active(ratings)
    return recommend.predict_pairs(_model(ratings), t.spark.createDataFrame([(user, item)], "user_id int, item_id int"))


@query("v06_predict_pairs")
def predict_pairs(t):
    parts = derived.rating_splits(t)
    model = recommend.train(parts["train"], iterations=10)
    return recommend.predict_pairs(model, parts["test"])


def asked(ratings, column):
    """The asked users or items: every rated one whose id is divisible by 20."""
    return ratings.where(F.col(column) % 20 == 0).select(column).distinct()


@query("v07_top_items")
def top_items(t):
    ratings = ratings_of(t)
    return recommend.top_items(_model(ratings), 10, asked(ratings, "user_id"))


@query("v07_top_items_of_user")
def top_items_of_user(t):
    ratings = ratings_of(t)
    user, _ = _most_active(ratings)
    return recommend.top_items(_model(ratings), 5, t.spark.createDataFrame([(user,)], "user_id int"))


@query("v08_top_users")
def top_users(t):
    ratings = ratings_of(t)
    return recommend.top_users(_model(ratings), 10, asked(ratings, "item_id"))


@query("v09_titled_items")
def titled_items(t):
    ratings = ratings_of(t)
    return recommend.with_titles(recommend.top_items(_model(ratings), 10, asked(ratings, "user_id")), derived.titles(t))


def _facts(t, asked_key):
    """Per asked id: whether the search gives the scores of all products, place by place, and how many blocks it met."""
    ratings = ratings_of(t)
    model = _model(ratings)
    sides = {"user_id": (model.userFactors, model.itemFactors), "item_id": (model.itemFactors, model.userFactors)}
    own, other = sides[asked_key]
    known = cut_lineage(asked(ratings, asked_key).withColumnRenamed(asked_key, "id").join(own, "id"))
    # Small blocks, so that the bound has something to leave out here; as many factors are sent at once as of usual ones.
    found = top_lists(known, other, 10, block_rows=64, piece=PIECE * BLOCK_ROWS // 64)
    # The model's own lists for a subset score all pairs too, in as few tasks as the subset has partitions once these are merged.
    whole = all_products(known, other, 10).select("id", "place", F.col("score").alias("full"))
    same = found.join(whole, ["id", "place"], "full").withColumn("same", F.coalesce(F.abs(F.col("score") - F.col("full")) < 1e-4, F.lit(False)))
    return same.groupBy(F.col("id").alias(asked_key)).agg(F.count(F.lit(1)).alias("n"), F.bool_and("same").alias("same"), F.max("visited").alias("visited"))


def _facts_sql(key, other):
    return f"""
WITH {derived.RATINGS_SQL}
SELECT CAST({key} AS INTEGER) AS {key}, least(10, (SELECT count(DISTINCT {other}) FROM ratings)) AS n, true AS same, true AS in_blocks
FROM ratings WHERE {key} % 20 = 0 GROUP BY {key}"""


def _within(facts, n_other):
    return facts.withColumn("in_blocks", F.col("visited").between(1, F.ceil(F.lit(n_other) / 64))).drop("visited")


@query("v07_search_equals_all_products", _facts_sql("user_id", "item_id"))
def search_of_items(t):
    return _within(_facts(t, "user_id"), t.lineitem.select("l_partkey").distinct().count())


@query("v08_search_equals_all_products", _facts_sql("item_id", "user_id"))
def search_of_users(t):
    return _within(_facts(t, "item_id"), t.orders.select("o_custkey").distinct().count())


@query("v07_blocks_visited")
def blocks_visited(t):
    """How many users were done after how many blocks of 64 items."""
    return _facts(t, "user_id").groupBy("visited").agg(F.count(F.lit(1)).alias("users")).orderBy("visited")


def _products(model, pairs):
    """Pairs with the product of their factors, next to the model's prediction."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("_u"))
    items = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("_v"))
    product = F.aggregate(F.zip_with("_u", "_v", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, p: s + p)
    near = F.abs(product - F.col("prediction")) < 1e-4
    return recommend.predict_pairs(model, pairs).join(users, "user_id").join(items, "item_id").withColumn("is_product", near).drop("_u", "_v")


_ACTIVE_SQL = f"""
WITH {derived.RATINGS_SQL},
user_one AS (SELECT user_id FROM ratings GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1),
item_one AS (SELECT item_id FROM ratings GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 1)"""


@query("v05_product_of_one", f"{_ACTIVE_SQL} SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, true AS is_product FROM user_one, item_one")
def product_of_one(t):
    ratings = ratings_of(t)
    user, item = _most_active(ratings)
    pair = t.spark.createDataFrame([(user, item)], "user_id int, item_id int")
    return _products(_model(ratings), pair).select("user_id", "item_id", "is_product")


_SPLIT_SQL = """('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), 1, 8))::BIGINT % 10"""


@query("v06_products_of_pairs", f"""
WITH {derived.RATINGS_SQL}, parted AS (SELECT *, {_SPLIT_SQL} AS bucket FROM ratings),
train AS (SELECT * FROM parted WHERE bucket < 8)
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, true AS is_product
FROM parted WHERE bucket = 9 AND user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)""")
def products_of_pairs(t):
    """Pairs with an unknown user or item are not there."""
    parts = derived.rating_splits(t)
    model = recommend.train(parts["train"], iterations=10)
    return _products(model, parts["test"]).select("user_id", "item_id", "is_product")


@query("v09_titles_of_places", f"""
WITH {derived.RATINGS_SQL}, names AS (SELECT p_partkey, p_name FROM part),
places AS (SELECT DISTINCT user_id FROM ratings WHERE user_id % 20 = 0)
SELECT CAST(user_id AS INTEGER) AS user_id, least(10, (SELECT count(DISTINCT item_id) FROM ratings)) AS n, true AS titled FROM places""")
def titles_of_places(t):
    """Per asked user, the number of places, and whether each title is that of its item."""
    named = t.part.select(F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("name"))
    found = titled_items(t).join(named, "item_id", "left")
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("title") == F.col("name")).alias("titled"))


@query("v10_serve_saved")
def serve_saved(t):
    path = fresh_path(t.spark, "v10")
    ratings = ratings_of(t)
    save_model(_model(ratings), path)
    user, item = _most_active(ratings)
    items = recommend.serve(t.spark, path, "U", user, 5, derived.titles(t))
    users = recommend.serve(t.spark, path, "M", item, 5, derived.titles(t))
    return items.withColumn("direction", F.lit("U")).unionByName(users.withColumn("direction", F.lit("M")))


@query("v10_saved_lists", f"""{_ACTIVE_SQL}
SELECT 'U' AS direction, CAST(range + 1 AS INTEGER) AS place, CAST(user_id AS INTEGER) AS asked, true AS as_trained, true AS falling FROM user_one, range(5)
UNION ALL SELECT 'M', CAST(range + 1 AS INTEGER), CAST(item_id AS INTEGER), true, true FROM item_one, range(5)""")
def saved_lists(t):
    """Lists served from disk, place by place against the scores of the model that was saved."""
    path = fresh_path(t.spark, "v10")
    ratings = ratings_of(t)
    model = _model(ratings)
    save_model(model, path)
    user, item = _most_active(ratings)
    out = None
    for direction, key, score_all in (("U", user, model.recommendForUserSubset), ("M", item, model.recommendForItemSubset)):
        column = "user_id" if direction == "U" else "item_id"
        served = recommend.serve(t.spark, path, direction, key, 5, derived.titles(t))
        whole = score_all(t.spark.createDataFrame([(key,)], f"{column} int"), 5).select(F.posexplode("recommendations").alias("at", "r")).select((F.col("at") + 1).alias("place"), F.col("r.rating").alias("full"))
        before = F.lag("score").over(Window.partitionBy(column).orderBy("place"))
        facts = served.withColumn("falling", F.coalesce(before >= F.col("score"), F.lit(True))).join(whole, "place").select(
            F.lit(direction).alias("direction"), "place", F.col(column).alias("asked"), (F.abs(F.col("score") - F.col("full")) < 1e-4).alias("as_trained"), "falling"
        )
        out = facts if out is None else out.unionByName(facts)
    return out
