"""Models stored for lookups, mergeable score counts and dictionaries built on the cluster."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.learning import dictionary, features, histograms, recommend, store
from loamwork.plans import derived
from loamwork.plans.recommending import _ACTIVE_SQL, _model, _most_active, ratings_of
from loamwork.plans.registry import query
from loamwork.workspace import fresh_path


def _stored_model(t):
    ratings = ratings_of(t)
    model, path = _model(ratings), fresh_path(t.spark, "factors")
    store.save_factors(model, path, 256)
    return ratings, model, path


@query("s10_stored_factors", f"""
WITH {derived.RATINGS_SQL}
SELECT 'user' AS side, count(DISTINCT user_id) AS n, true AS same FROM ratings UNION ALL SELECT 'item', count(DISTINCT item_id), true FROM ratings""")
def stored_factors(t):
    """Both sides of a model written for lookups: as many factors as there are ids, each as trained."""
    _, model, path = _stored_model(t)
    out = None
    for side, attribute in store.SIDES.items():
        read = t.spark.read.parquet(f"{path}/{side}").select("id", F.col("features").alias("read"))
        both = getattr(model, attribute).join(read, "id", "left")
        facts = both.agg(F.lit(side).alias("side"), F.count("read").alias("n"), F.bool_and(F.coalesce(F.col("features") == F.col("read"), F.lit(False))).alias("same"))
        out = facts if out is None else out.unionByName(facts)
    return out


@query("s11_looked_up_pair", f"{_ACTIVE_SQL} SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id, true AS as_trained, true AS unknown_is_null FROM user_one, item_one")
def looked_up_pair(t):
    """V05 from disk: the rating of one pair from two point lookups, against the model that was saved."""
    ratings, model, path = _stored_model(t)
    user, item = _most_active(ratings)
    pair = t.spark.createDataFrame([(user, item, store.predict_pair(t.spark, path, user, item), store.predict_pair(t.spark, path, -5, item) is None)], "user_id int, item_id int, served double, unknown_is_null boolean")
    return recommend.predict_pairs(model, pair).select("user_id", "item_id", (F.abs(F.col("prediction") - F.col("served")) < 1e-5).alias("as_trained"), "unknown_is_null")


@query("v10_lists_by_lookup", f"""{_ACTIVE_SQL}
SELECT 'U' AS direction, CAST(range + 1 AS INTEGER) AS place, CAST(user_id AS INTEGER) AS asked, true AS as_trained FROM user_one, range(5)
UNION ALL SELECT 'M', CAST(range + 1 AS INTEGER), CAST(item_id AS INTEGER), true FROM item_one, range(5)""")
def lists_by_lookup(t):
    """Lists served from one factor and the blocks in its reach, place by place against all products of the saved model."""
    ratings, model, path = _stored_model(t)
    user, item = _most_active(ratings)
    out = None
    for direction, key, column, score_all in (("U", user, "user_id", model.recommendForUserSubset), ("M", item, "item_id", model.recommendForItemSubset)):
        served = store.serve_stored(t.spark, path, direction, key, 5, derived.titles(t))
        whole = score_all(t.spark.createDataFrame([(key,)], f"{column} int"), 5).select(F.posexplode("recommendations").alias("at", "r")).select((F.col("at") + 1).alias("place"), F.col("r.rating").alias("full"))
        facts = served.join(whole, "place").select(F.lit(direction).alias("direction"), "place", F.col(column).alias("asked"), (F.abs(F.col("score") - F.col("full")) < 1e-4).alias("as_trained"))
        out = facts if out is None else out.unionByName(facts)
    return out


_SCORED_SQL = """
scored AS (
  SELECT 0.02 * l_quantity + 3.0 * l_discount - 2.0 * l_tax AS score, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label,
         l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)"""
_AREA_SQL = """
by_score AS (SELECT {by} AS part, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY ALL),
running AS (SELECT part, pos, neg, sum(neg) OVER (PARTITION BY part ORDER BY score) - neg AS below FROM by_score)
SELECT part, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, round(sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc
FROM running GROUP BY part HAVING sum(pos) > 0 AND sum(neg) > 0"""


def _yearly(t):
    rows = t.lineitem.withColumn("score", 0.02 * F.col("l_quantity") + 3.0 * F.col("l_discount") - 2.0 * F.col("l_tax"))
    return rows.select("score", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"), "l_linestatus", F.year("l_shipdate").alias("year"))


@query("e02_area_of_merged_years", f"WITH {_SCORED_SQL}, {_AREA_SQL.format(by='l_linestatus')}")
def area_of_merged_years(t):
    """Counts per year and status are kept; the areas by status follow from adding up the years."""
    yearly = derived.stored(t, histograms.score_counts(_yearly(t), ["year", "l_linestatus"]), "score-counts")
    merged = histograms.merged(yearly, by=["l_linestatus"])
    return histograms.area(merged, ["l_linestatus"]).where("positives > 0 AND negatives > 0").select(F.col("l_linestatus").alias("part"), "positives", "negatives", F.round("auc", 6).alias("auc"))


@query("e06_area_by_year", f"WITH {_SCORED_SQL}, {_AREA_SQL.format(by='year')}")
def area_by_year(t):
    yearly = histograms.score_counts(_yearly(t), ["year"])
    return histograms.area(yearly, ["year"]).where("positives > 0 AND negatives > 0").select(F.col("year").alias("part"), "positives", "negatives", F.round("auc", 6).alias("auc"))


@query("e02_binned_area_bound", f"""WITH {_SCORED_SQL}, {_AREA_SQL.format(by='CAST(0 AS INTEGER)').replace('SELECT part, CAST', 'SELECT true AS within, CAST')}""")
def binned_area_bound(t):
    """The exact area, and whether that of bins a twentieth wide is within its stated error of it."""
    rows = derived.stored(t, _yearly(t).select("score", "label"), "scores")
    exact = histograms.area(histograms.score_counts(rows)).select("positives", "negatives", F.round("auc", 6).alias("auc"), F.col("auc").alias("whole"))
    binned = histograms.area(histograms.score_counts(rows, width=0.05)).select(F.col("auc").alias("about"), "error")
    return exact.join(F.broadcast(binned)).select("positives", "negatives", "auc", (F.abs(F.col("whole") - F.col("about")) <= F.col("error") + 1e-12).alias("within"))


_PARTS_SQL = """
ranked AS (SELECT CAST(l_partkey AS VARCHAR) AS value, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey)"""


@query("m01_index_by_dictionary", f"""
WITH {_PARTS_SQL}
SELECT l_linestatus, CAST(coalesce(idx, (SELECT count(*) FROM ranked)) AS DOUBLE) AS l_partkey_index, count(*) AS n
FROM lineitem LEFT JOIN ranked ON CAST(l_partkey AS VARCHAR) = value GROUP BY 1, 2""")
def index_by_dictionary(t):
    """Part keys ranked by the finished lines; keys that only open lines have share the index after the last."""
    lines = t.lineitem.select("l_partkey", "l_linestatus")
    values = derived.stored(t, dictionary.ranked_values(lines.where("l_linestatus = 'F'"), "l_partkey"), "part-dictionary")
    return dictionary.indexed(lines, "l_partkey", values).groupBy("l_linestatus", "l_partkey_index").agg(F.count(F.lit(1)).alias("n"))


@query("m02_slots_by_dictionary", f"""
WITH {derived.BINARY_SQL}, langs AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS idx FROM pages_in GROUP BY lang)
SELECT doc_id, CAST(idx AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM pages_in p JOIN langs USING (lang)""")
def slots_by_dictionary(t):
    docs = derived.stored(t, derived.labelled_documents(t).select("doc_id", "lang"), "langs")
    values = derived.stored(t, dictionary.ranked_values(docs, "lang"), "lang-dictionary")
    ready = dictionary.slots(dictionary.indexed(docs, "lang", values), "lang_index", values.count(), "lang_slots")
    return features.vector_rows(ready, ["doc_id"], "lang_slots").filter("value <> 0")
