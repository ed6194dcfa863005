"""Sorts and top-k (O), set operations and sampling (U), and position-based splits (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.functions import numeric, text
from loamwork.operators import sets, sorting, splits
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.sources.writers import joined_fields


def _pairs(t):
    return t.lineitem.select(
        F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("v"), "l_orderkey", "l_partkey", "l_linenumber"
    )


_PAIRS = "SELECT l_suppkey AS k, l_quantity AS v, l_orderkey, l_partkey, l_linenumber FROM lineitem"


@query("o01_sort_asc", f"{_PAIRS} ORDER BY k, l_orderkey, l_partkey, l_linenumber")
def sort_asc(t):
    return sorting.ordered(_pairs(t), "k", "l_orderkey", "l_partkey", "l_linenumber")


@query("o01_sort_desc", f"{_PAIRS} ORDER BY k DESC, l_orderkey, l_partkey, l_linenumber")
def sort_desc(t):
    return sorting.ordered(_pairs(t), F.desc("k"), "l_orderkey", "l_partkey", "l_linenumber")


@query("o02_smallest", "SELECT l_quantity AS v FROM lineitem ORDER BY l_quantity LIMIT 3")
def smallest(t):
    return sorting.first_rows(t.lineitem.select(F.col("l_quantity").alias("v")), 3, "v")


@query("o02_largest", "SELECT l_quantity AS v FROM lineitem ORDER BY -l_quantity LIMIT 3")
def largest(t):
    return sorting.first_rows(t.lineitem.select(F.col("l_quantity").alias("v")), 3, -F.col("v"))


def _text_parts(t):
    line = joined_fields("p_partkey", "p_name", "p_size", sep="|")
    f = t.part.select(text.split_on(line, "|").alias("f"))
    return f.select(*[F.col("f")[i].alias(name) for i, name in enumerate(["item", "title", "size"])])


@query("o03_top_by_text_number", "SELECT CAST(p_partkey AS VARCHAR) AS item, p_name AS title, CAST(p_size AS VARCHAR) AS size FROM part ORDER BY p_size DESC, p_partkey LIMIT 5")
def top_by_text_number(t):
    return sorting.first_rows(_text_parts(t), 5, numeric.to_int(F.col("size")).desc(), numeric.to_int(F.col("item")))


@query("o03_bottom_by_text_number", "SELECT CAST(p_partkey AS VARCHAR) AS item, p_name AS title, CAST(p_size AS VARCHAR) AS size FROM part ORDER BY p_size, p_partkey LIMIT 5")
def bottom_by_text_number(t):
    return sorting.first_rows(_text_parts(t), 5, numeric.to_int(F.col("size")), numeric.to_int(F.col("item")))


@query("o04_order_by", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def order_by(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy("c_acctbal", "c_custkey")


@query("o04_order_by_desc", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def order_by_desc(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("o05_mixed_directions", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderstatus DESC, o_orderpriority, o_orderkey")
def mixed_directions(t):
    columns = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return columns.orderBy(["o_orderstatus", "o_orderpriority", "o_orderkey"], ascending=[0, 1, 1])


@query("o06_limit", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5")
def limit(t):
    return sorting.first_rows(t.customer.select("c_custkey", "c_name"), 5, "c_custkey")


@query("o07_two_key_numeric_sort", f"WITH {derived.RATINGS_SQL} SELECT user_id, item_id, round(rating, 6) AS rating FROM ratings ORDER BY user_id, item_id")
def two_key_numeric_sort(t):
    return sorting.ordered(derived.ratings(t).withColumn("rating", F.round("rating", 6)), "user_id", "item_id")


_CUTS = [0.2, 0.4, 0.6, 0.8, 1.0]


@query("o08_best_setting", f"""
WITH {derived.LINES_SQL}, grid(grid_position, cut) AS (VALUES {", ".join(f"({i}, CAST({c} AS DOUBLE))" for i, c in enumerate(_CUTS))}),
metrics AS (SELECT grid_position, cut, round(avg(CASE WHEN (score > cut) = (label = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored, grid GROUP BY grid_position, cut)
SELECT * FROM metrics ORDER BY accuracy DESC, grid_position LIMIT 1""")
def best_setting(t):
    grid = F.array(*[F.struct(F.lit(i).alias("grid_position"), F.lit(c).alias("cut")) for i, c in enumerate(_CUTS)])
    tried = derived.scored_lines(t).select("score", "label", F.inline(grid))
    right = ((F.col("score") > F.col("cut")) == (F.col("label") == 1)).cast("double")
    metrics = tried.groupBy("grid_position", "cut").agg(F.round(F.avg(right), 6).alias("accuracy"))
    return sorting.best_setting(metrics, "accuracy", larger_is_better=True)


def _nations_of(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).alias("band"))
    suppliers = t.supplier.select(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 1000).alias("band"))
    return customers, suppliers


_C = "SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer"
_S = "SELECT s_nationkey AS nation, CAST(floor(s_acctbal / 1000) AS BIGINT) AS band FROM supplier"


@query("u01_union", f"{_C} UNION ALL {_S} UNION ALL SELECT n_nationkey, CAST(n_regionkey AS BIGINT) FROM nation")
def union(t):
    extra = t.nation.select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").cast("bigint").alias("band"))
    return sets.union_all(*_nations_of(t), extra)


@query("u02_intersection", f"{_C} INTERSECT {_S}")
def intersection(t):
    return sets.intersection(*_nations_of(t))


@query("u03_subtract", f"SELECT * FROM ({_C}) c WHERE NOT EXISTS (SELECT 1 FROM ({_S}) s WHERE s.nation IS NOT DISTINCT FROM c.nation AND s.band IS NOT DISTINCT FROM c.band)")
def subtract(t):
    return sets.subtract_values(*_nations_of(t))


@query("u04_distinct", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_orderpriority").distinct()


@query("u04_distinct_pairs", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_pairs(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("u05_hash_split", """
WITH b AS (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS bucket FROM documents)
SELECT doc_id, CASE WHEN bucket < 8 THEN 'train' WHEN bucket < 9 THEN 'validation' ELSE 'test' END AS split FROM b""")
def hash_split(t):
    weights = {"train": 8, "validation": 1, "test": 1}
    return t.documents.select("doc_id", splits.hash_split(F.col("doc_id"), weights).alias("split"))


@query("u05_random_split")
def random_split(t):
    first, second = splits.random_split(t.documents.select("doc_id"), [0.4, 0.6], seed=0)
    return first.withColumn("split", F.lit("first")).unionAll(second.withColumn("split", F.lit("second")))


@query("w01_leave_range_out", """
SELECT o_orderkey, o_custkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) BETWEEN 3 AND 6 THEN 'test' ELSE 'base' END AS split FROM orders""")
def leave_range_out(t):
    return splits.leave_range_out(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", ["o_orderkey"], 3, 6)


@query("w01_leave_range_out_capped", """
WITH numbered AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
flagged AS (SELECT *, n BETWEEN 1 AND 2 AS hit FROM numbered),
capped AS (SELECT *, CASE WHEN hit THEN row_number() OVER (PARTITION BY hit ORDER BY o_orderkey) END AS place FROM flagged)
SELECT o_orderkey, o_custkey, CASE WHEN place <= 100 THEN 'test' ELSE 'base' END AS split FROM capped""")
def leave_range_out_capped(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    return splits.leave_range_out(orders, "o_custkey", ["o_orderkey"], 1, 2, max_test=100)


@query("w02_contiguous_folds", """
SELECT conv_id, turn, CAST(floor((row_number() OVER (ORDER BY conv_id, turn) - 1) * 5 / (SELECT count(*) FROM conversations)) AS BIGINT) AS fold FROM conversations""")
def contiguous_folds(t):
    return splits.contiguous_folds(t.conversations.select("conv_id", "turn"), ["conv_id", "turn"], 5)


@query("w02_fixed_blocks", """
SELECT o_orderkey, least(CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 200) AS BIGINT), 5) AS fold FROM orders""")
def fixed_blocks(t):
    return splits.contiguous_folds(t.orders.select("o_orderkey"), ["o_orderkey"], 5, block_rows=200)
