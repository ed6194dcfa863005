"""Inputs of the workloads, derived from the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from loamwork.functions.text import occurrences
from loamwork.operators.splits import split_frames
from loamwork.sources.catalog import Tables
from loamwork.workspace import fresh_path

RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(1 + l_quantity % 5) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""

BINARY_SQL = """
pages_in AS (
  SELECT d.doc_id, d.lang, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS n_spaces,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) AS DOUBLE) AS n_lines,
         CAST(l.quality AS DOUBLE) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

HOURLY_SQL = """
hours AS (
  SELECT CAST(dayofyear(ts) AS BIGINT) AS day_of_year, CAST(hour(ts) AS DOUBLE) AS hr,
         CAST(isodow(ts) AS DOUBLE) - 1 AS weekday, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_value,
         CAST(count(DISTINCT user_id) AS DOUBLE) AS n_users, CAST(count(*) AS DOUBLE) AS cnt
  FROM events GROUP BY dayofyear(ts), hour(ts), isodow(ts))"""

LINES_SQL = """
scored AS (
  SELECT 0.02 * l_quantity + 3.0 * l_discount - 2.0 * l_tax AS score,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS label, l_linestatus
  FROM lineitem)"""


def ratings(t: Tables) -> DataFrame:
    """(user_id, item_id, rating from 1 to 5), one row per pair."""
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return bought.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.avg(1 + F.col("l_quantity") % 5).alias("rating")
    )


def stored(t: Tables, df: DataFrame, name: str) -> DataFrame:
    """A narrow frame written once to the shared folder, for queries that read it several times."""
    path = fresh_path(t.spark, name)
    df.write.parquet(path)
    return t.spark.read.parquet(path)


def stored_ratings(t: Tables) -> DataFrame:
    return stored(t, ratings(t), "ratings")


def titles(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("title"))


def labelled_documents(t: Tables) -> DataFrame:
    """Documents with a category, three numbers and a 0/1 label."""
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        occurrences(F.col("text"), " ").cast("double").alias("n_spaces"),
        occurrences(F.col("text"), "\n").cast("double").alias("n_lines"),
        F.col("quality").cast("double").alias("label"),
    )


def unlabelled_documents(t: Tables) -> DataFrame:
    """The documents that no label covers."""
    return t.documents.join(t.labels, "doc_id", "left_anti").select(
        "doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"),
        occurrences(F.col("text"), " ").cast("double").alias("n_spaces"),
        occurrences(F.col("text"), "\n").cast("double").alias("n_lines"),
    )


def vectors(t: Tables) -> DataFrame:
    """Ten-class rows with one numeric vector."""
    return t.embeddings.select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("label"),
    )


def hours(t: Tables) -> DataFrame:
    """Events per hour with calendar features."""
    ts = F.col("ts")
    return t.events.groupBy(
        F.dayofyear(ts).cast("bigint").alias("day_of_year"), F.hour(ts).cast("double").alias("hr"),
        F.weekday(ts).cast("double").alias("weekday"),
    ).agg(
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("mean_value"),
        F.countDistinct("user_id").cast("double").alias("n_users"),
        F.count(F.lit(1)).cast("double").alias("cnt"),
    )


def sales_lines(t: Tables) -> DataFrame:
    """Order lines with a category, four numbers and a 0/1 label."""
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
    )


def scored_lines(t: Tables) -> DataFrame:
    """Order lines with a fixed linear score and a 0/1 label."""
    score = 0.02 * F.col("l_quantity") + 3.0 * F.col("l_discount") - 2.0 * F.col("l_tax")
    return t.lineitem.select(
        score.alias("score"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        "l_linestatus",
    )


def document_splits(t: Tables) -> dict[str, DataFrame]:
    documents = stored(t, labelled_documents(t), "documents")
    return split_frames(documents, F.col("doc_id"), {"train": 8, "validation": 1, "test": 1})


def vector_splits(t: Tables) -> dict[str, DataFrame]:
    return split_frames(vectors(t), F.col("vec_id"), {"train": 7, "test": 3})


def hour_splits(t: Tables) -> dict[str, DataFrame]:
    row = F.concat_ws(":", F.col("day_of_year").cast("string"), F.col("hr").cast("string"))
    return split_frames(stored(t, hours(t), "hours"), row, {"train": 7, "test": 3})


def rating_splits(t: Tables) -> dict[str, DataFrame]:
    pair = F.concat_ws(":", F.col("user_id").cast("string"), F.col("item_id").cast("string"))
    frames = split_frames(stored_ratings(t), pair, {"train": 8, "validation": 1, "test": 1})
    return {
        name: f.select(F.col("user_id").cast("int"), F.col("item_id").cast("int"), F.col("rating").cast("float"))
        for name, f in frames.items()
    }


NUMBERS = ["n_chars", "n_spaces", "n_lines"]
HOUR_FEATURES = ["hr", "weekday", "mean_value"]
