"""Filters and predicates (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamwork.functions.text import split_on
from loamwork.plans.registry import query
from loamwork.sources import readers, writers
from loamwork.workspace import fresh_path

_LINE = "l_orderkey, l_partkey, l_quantity"


@query("f01_less_than", f"SELECT {_LINE} FROM lineitem WHERE l_quantity < 3")
def less_than(t):
    return t.lineitem.filter(F.col("l_quantity") < 3).select("l_orderkey", "l_partkey", "l_quantity")


@query("f01_equal", f"SELECT {_LINE} FROM lineitem WHERE l_quantity = 3")
def equal(t):
    return t.lineitem.filter(F.col("l_quantity") == 3).select("l_orderkey", "l_partkey", "l_quantity")


@query("f02_open_interval", f"SELECT {_LINE} FROM lineitem WHERE 1 < l_quantity AND l_quantity < 5")
def open_interval(t):
    q = F.col("l_quantity")
    return t.lineitem.filter((q > 1) & (q < 5)).select("l_orderkey", "l_partkey", "l_quantity")


@query("f03_or_ranges", f"SELECT {_LINE} FROM lineitem WHERE l_quantity >= 48 OR l_quantity < 3")
def or_ranges(t):
    q = F.col("l_quantity")
    return t.lineitem.filter((q >= 48) | (q < 3)).select("l_orderkey", "l_partkey", "l_quantity")


@query("f04_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ra')")
def contains(t):
    return t.part.filter(F.col("p_name").contains("ra")).select("p_partkey", "p_name")


@query("f05_by_key", "SELECT l_linenumber AS k, l_quantity AS v FROM lineitem WHERE l_linenumber < 5")
def by_key(t):
    return t.lineitem.select(F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("v")).filter("k < 5")


@query("f05_by_value", "SELECT l_linenumber AS k, l_quantity AS v FROM lineitem WHERE l_quantity < 5")
def by_value(t):
    return t.lineitem.select(F.col("l_linenumber").alias("k"), F.col("l_quantity").alias("v")).filter("v < 5")


_ORDER_FILTER = "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 100000"


@query("f06_chained_strings", _ORDER_FILTER)
def chained_strings(t):
    return (
        t.orders.filter("o_orderstatus = 'F'").filter("o_orderpriority = '1-URGENT'").filter("o_totalprice > 100000")
    )


@query("f07_one_string", _ORDER_FILTER)
def one_string(t):
    return t.orders.filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT' and o_totalprice > 100000")


@query("f08_column_expression", _ORDER_FILTER)
def column_expression(t):
    o = t.orders
    return o.filter((o.o_orderstatus == "F") & (o["o_orderpriority"] == "1-URGENT") & (F.col("o_totalprice") > 100000))


@query("f09_sql_where", _ORDER_FILTER)
def sql_where(t):
    return t.sql(_ORDER_FILTER.replace("FROM orders", "FROM orders_in"), orders_in=t.orders)


@query("f10_raw_string_fields", "SELECT CAST(o_orderkey AS VARCHAR) AS f0, o_orderstatus AS f1, o_orderpriority AS f2 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def raw_string_fields(t):
    line = writers.joined_fields("o_orderkey", "o_orderstatus", "o_orderpriority", sep="|")
    f = t.orders.select(split_on(line, "|").alias("f"))
    kept = f.filter((F.col("f")[1] == "F") & (F.col("f")[2] == "1-URGENT"))
    return kept.select(*[F.col("f")[i].alias(f"f{i}") for i in range(3)])


@query("f11_null_rejecting", """
SELECT c_custkey, c_name, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def null_rejecting(t):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.filter("r_name = 'ASIA'").select("c_custkey", "c_name", "n_name", "r_name")


@query("f12_lookup", "SELECT l_quantity AS v FROM lineitem WHERE l_returnflag = 'R'")
def lookup(t):
    return t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_quantity").alias("v"))


@query("f13_drop_header", "SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || c_mktsegment AS value FROM customer")
def drop_header(t):
    path = fresh_path(t.spark, "f13")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    writers.write_delimited(t.customer.select(*columns), path, header=True)
    return readers.drop_header_lines(readers.read_lines(t.spark, path), ",".join(columns))
