"""Aggregations (A) and reporting tables (R)."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from loamwork.learning import recommend
from loamwork.operators import aggregates, joins, reports
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.sources.catalog import Tables
from loamwork.workspace import fresh_path


@query("a01_global", "SELECT count(*) AS n, sum(l_quantity) AS total, round(avg(l_quantity), 6) AS mean, min(l_quantity) AS smallest, max(l_quantity) AS largest FROM lineitem")
def global_summary(t):
    q = F.col("l_quantity")
    return t.lineitem.agg(
        F.count(q).alias("n"), F.sum(q).alias("total"), F.round(F.avg(q), 6).alias("mean"),
        F.min(q).alias("smallest"), F.max(q).alias("largest"),
    )


@query("a02_population_deviation", "SELECT round(stddev_pop(l_quantity), 6) AS stdev FROM lineitem")
def population_deviation(t):
    return t.lineitem.agg(F.round(F.stddev_pop("l_quantity"), 6).alias("stdev"))


@query("a03_one_pass_summary", "SELECT count(l_quantity) AS n, sum(l_quantity) AS total, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS stdev, min(l_quantity) AS smallest, max(l_quantity) AS largest FROM lineitem")
def one_pass_summary(t):
    s = aggregates.summary(t.lineitem, "l_quantity")
    return s.withColumns({c: F.round(c, 6) for c in ("mean", "stdev")})


@query("a04_sum_by_key", "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
def sum_by_key(t):
    return aggregates.sum_by(t.lineitem, ["l_suppkey"], "l_quantity")


@query("a05_word_count", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
def word_count(t):
    return aggregates.word_count(t.documents, "text")


@query("a06_group_members", "SELECT CASE WHEN l_quantity % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, l_quantity, count(*) AS copies FROM lineitem GROUP BY ALL")
def group_members(t):
    parity = F.when(F.col("l_quantity") % 2 == 0, "even").otherwise("odd")
    return aggregates.group_members(t.lineitem, parity, "l_quantity", "parity")


@query("a06_group_member_lists", "WITH placed AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 10 AS part FROM orders) SELECT o_custkey AS customer, CAST(part AS INTEGER) AS part, CAST(count(*) AS INTEGER) AS n, array_to_string(list_sort(list(o_orderkey)), ',') AS members FROM placed GROUP BY o_custkey, part")
def group_member_lists(t):
    lists = aggregates.group_member_lists(t.orders, F.col("o_custkey"), "o_orderkey", "customer", list_size=10)
    members = F.array_join(F.col("members").cast("array<string>"), ",")
    return lists.select("customer", "part", F.size("members").alias("n"), members.alias("members"))


@query("a07_count_by_key", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def count_by_key(t):
    return aggregates.count_by(t.lineitem, "l_suppkey")


@query("a08_last_value", "SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def last_value(t):
    return aggregates.last_value_by(t.orders, "o_custkey", "o_orderpriority", "o_orderkey")


_GROUPED = "SELECT o_orderstatus, o_orderpriority, count(*) AS counts FROM {orders} GROUP BY o_orderstatus, o_orderpriority"


@query("a09_sql_group_one", "SELECT o_orderstatus, count(*) AS counts FROM orders GROUP BY o_orderstatus")
def sql_group_one(t):
    return t.sql("SELECT o_orderstatus, count(*) AS counts FROM orders_in GROUP BY o_orderstatus", orders_in=t.orders)


@query("a09_sql_group_two", _GROUPED.format(orders="orders"))
def sql_group_two(t):
    return t.sql(_GROUPED.format(orders="orders_in"), orders_in=t.orders)


@query("a10_group_count_sorted", "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL ORDER BY 1, 2")
def group_count_sorted(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").count().orderBy("o_orderstatus", "o_orderpriority")


@query("a11_composite_key_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def composite_key_count(t):
    return aggregates.count_by(t.lineitem, "l_returnflag", "l_linestatus")


@query("a12_crosstab", """
SELECT o_orderpriority AS o_orderpriority_o_orderstatus, count(*) FILTER (o_orderstatus = 'F') AS F,
       count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P
FROM orders GROUP BY o_orderpriority""")
def crosstab(t):
    return aggregates.crosstab(t.orders, "o_orderpriority", "o_orderstatus")


_DESCRIBED = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query("a13_describe", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{stat}' AS stat, round(CAST({expression} AS DOUBLE), 6) AS value FROM lineitem"
    for c in _DESCRIBED
    for stat, expression in [("count", f"count({c})"), ("mean", f"avg({c})"), ("stddev", f"stddev_samp({c})"), ("min", f"min({c})"), ("max", f"max({c})")]))
def describe(t):
    return aggregates.describe(t.lineitem, _DESCRIBED).withColumn("value", F.round("value", 6))


@query("a13_describe_text", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS smallest, max({c}) AS largest, avg(TRY_CAST({c} AS DOUBLE)) AS mean FROM orders"
    for c in ["o_orderstatus", "o_orderpriority"]))
def describe_text(t):
    return aggregates.describe_text(t.orders, ["o_orderstatus", "o_orderpriority"])


@query("a14_count_distinct", "SELECT count(DISTINCT o_custkey) AS n_users FROM orders")
def count_distinct(t):
    return t.orders.agg(F.countDistinct("o_custkey").alias("n_users"))


@query("a15_running_totals", "SELECT sum(l_quantity) AS total, count(*) AS num, round(sum(l_quantity) / count(*), 6) AS average FROM lineitem")
def running_totals(t):
    totals = t.lineitem.agg(F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("num"))
    return totals.withColumn("average", F.round(F.col("total") / F.col("num"), 6))


@query("a15_observed_totals", "SELECT l_returnflag, count(*) AS n, (SELECT sum(l_quantity) FROM lineitem) AS total, (SELECT count(*) FROM lineitem) AS num FROM lineitem GROUP BY l_returnflag")
def observed_totals(t):
    """Counters that ride along with another job over the same rows.

    The job runs in a session of its own: once a session has observed anything it cannot be serialised, and
    some fitted classifiers carry their session along when they score.
    """
    seen, lines = Observation("totals"), Tables(t.spark.newSession(), t.folder).lineitem
    watched = lines.observe(seen, F.sum("l_quantity").alias("total"), F.count(F.lit(1)).alias("num"))
    path = fresh_path(t.spark, "a15")
    aggregates.count_by(watched, "l_returnflag").write.parquet(path)
    counted = t.spark.read.parquet(path)
    return counted.select("*", F.lit(seen.get["total"]).alias("total"), F.lit(seen.get["num"]).cast("bigint").alias("num"))


@query("a16_sum_of_squares", "SELECT sum((l_quantity - 25) * (l_quantity - 25)) AS total FROM lineitem")
def sum_of_squares(t):
    return aggregates.sum_of_squares(t.lineitem, F.col("l_quantity") - 25)


@query("a17_ratings_profile", f"WITH {derived.RATINGS_SQL} SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM ratings")
def ratings_profile(t):
    return recommend.profile(derived.ratings(t))



def _region_counts(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.counts_by_attribute(t.customer, "c_nationkey", nations, "n_nationkey", "r_name")


@query("r01_counts_table", """
SELECT r_name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def counts_table(t):
    return _region_counts(t)


@query("r01_transposed_counts", """
SELECT 'n' AS measure, """ + ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM orders")
def transposed_counts(t):
    return reports.transposed_counts(t.orders, "o_orderpriority")


@query("r02_shares", "SELECT c_mktsegment, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM customer), 1) AS percent FROM customer GROUP BY c_mktsegment")
def shares(t):
    return reports.shares(t.customer, "c_mktsegment")
