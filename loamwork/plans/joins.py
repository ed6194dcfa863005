"""Joins (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.operators import joins
from loamwork.operators.sorting import top_per_key
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.sources.readers import from_records


def _line_pairs(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("v"))


def _supplier_pairs(t):
    return t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("w"))


@query("j01_inner", "SELECT l_suppkey AS k, l_quantity AS v, s_acctbal AS w FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def inner(t):
    return joins.matched(_line_pairs(t), _supplier_pairs(t), ["k"])


def _customer_keys(t):
    return t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))


def _event_keys(t):
    return t.events.select(F.col("user_id").alias("k"), "event_id")


@query("j02_left_outer", "SELECT c_custkey AS k, c_mktsegment AS segment, event_id FROM customer LEFT JOIN events ON c_custkey = user_id")
def left_outer(t):
    return joins.left_outer(_customer_keys(t), _event_keys(t), ["k"])


@query("j03_right_outer", "SELECT c_custkey AS k, c_mktsegment AS segment, event_id FROM events RIGHT JOIN customer ON c_custkey = user_id")
def right_outer(t):
    return joins.right_outer(_event_keys(t), _customer_keys(t), ["k"])


@query("j04_anti", "SELECT c_custkey AS k, c_mktsegment AS segment FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def anti(t):
    return joins.anti(_customer_keys(t), _event_keys(t), ["k"])


@query("j05_all_pairs", "SELECT s.c_mktsegment AS segment, p.o_orderpriority AS priority FROM (SELECT DISTINCT c_mktsegment FROM customer) s CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p")
def all_pairs(t):
    segments = t.customer.select(F.col("c_mktsegment").alias("segment")).distinct()
    priorities = t.orders.select(F.col("o_orderpriority").alias("priority")).distinct()
    return joins.all_pairs(segments, priorities)


@query("j06_left_on_expression", "SELECT c_custkey, c_name, c_nationkey, n_nationkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_on_expression(t):
    joined = t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey, "left")
    return joined.select("c_custkey", "c_name", "c_nationkey", "n_nationkey", "n_name")


_SQL_LEFT = """
SELECT u.c_custkey, u.c_name, u.c_mktsegment, z.n_name, z.n_regionkey
FROM {users} u LEFT JOIN {zips} z ON u.c_nationkey = z.n_nationkey WHERE z.n_name = 'NATION_7'"""


@query("j07_sql_left_where", _SQL_LEFT.format(users="customer", zips="nation"))
def sql_left_where(t):
    return t.sql(_SQL_LEFT.format(users="user_in", zips="zip_in"), user_in=t.customer, zip_in=t.nation)


@query("j08_left_join_group_count", """
SELECT quality, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY quality""")
def left_join_group_count(t):
    return joins.counts_by_attribute(t.documents, "doc_id", t.labels, "doc_id", "quality")


@query("j09_literal_lookup", """
SELECT o_orderkey, m.meaning FROM orders
JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS m(code, meaning) ON o_orderstatus = m.code""")
def literal_lookup(t):
    codes = from_records(t.spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, meaning string")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    return joins.lookup_join(orders, codes, ["o_orderstatus"]).select("o_orderkey", "meaning")


@query("j10_broadcast_lookup", "SELECT l_orderkey, l_partkey, l_suppkey, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def broadcast_lookup(t):
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    return joins.lookup_join(lines, names, ["l_suppkey"]).select("l_orderkey", "l_partkey", "l_suppkey", "s_name")


@query("j11_composite_key", f"""
WITH {derived.RATINGS_SQL},
predicted AS (SELECT user_id, item_id, CAST(1 + (user_id * 7 + item_id * 3) % 5 AS DOUBLE) AS prediction FROM ratings)
SELECT p.user_id, p.item_id, p.prediction, round(r.rating, 6) AS rating
FROM predicted p JOIN ratings r ON p.user_id = r.user_id AND p.item_id = r.item_id""")
def composite_key(t):
    actual = derived.stored_ratings(t)
    predicted = actual.select(
        "user_id", "item_id", (1 + (F.col("user_id") * 7 + F.col("item_id") * 3) % 5).cast("double").alias("prediction")
    )
    return joins.matched(predicted, actual, ["user_id", "item_id"]).withColumn("rating", F.round("rating", 6))


@query("j12_titles", f"""
WITH {derived.RATINGS_SQL},
placed AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS place FROM ratings)
SELECT user_id, place, item_id, p_name AS title FROM placed JOIN part ON item_id = p_partkey WHERE place <= 3""")
def recommended_titles(t):
    best = top_per_key(derived.ratings(t), ["user_id"], 3, F.desc("rating"), F.asc("item_id"))
    titles = t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
    return joins.lookup_join(best, titles, ["item_id"]).select("user_id", "place", "item_id", "title")


@query("j13_text_to_number_key", """
WITH users AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'T' || CAST(c_nationkey AS VARCHAR) ELSE lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS zipcode FROM customer)
SELECT c_custkey, zipcode, n_name FROM users LEFT JOIN nation ON TRY_CAST(zipcode AS BIGINT) = n_nationkey""")
def text_to_number_key(t):
    nation = F.col("c_nationkey").cast("string")
    zipcode = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("T"), nation)).otherwise(F.lpad(nation, 5, "0"))
    users = t.customer.select("c_custkey", zipcode.alias("zipcode"))
    return joins.text_key_join(users, "zipcode", t.nation, "n_nationkey").select("c_custkey", "zipcode", "n_name")
