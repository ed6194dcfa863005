"""Schema and projection (P), scalar functions (X) and the Python function surface (D)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from loamwork.functions import lookup, numeric, text, vectorised
from loamwork.operators import positions, projection
from loamwork.plans.registry import query
from loamwork.sources import catalog, readers, schemas

_USER_LINE = "concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)"


def _user_fields(t):
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")
    return t.customer.select(text.split_on(line, "|").alias("f"))


@query("p01_typed_records", "SELECT c_custkey AS userid, c_name AS name, CAST(c_nationkey AS BIGINT) AS zipcode, c_mktsegment AS occupation FROM customer")
def typed_records(t):
    f = F.col("f")
    return _user_fields(t).select(
        numeric.to_int(text.field(f, 0)).alias("userid"), text.field(f, 1).alias("name"),
        numeric.to_int(text.field(f, 2)).alias("zipcode"), text.field(f, 3).alias("occupation"),
    )


@query("p02_frame_from_records", """
SELECT c.code, c.meaning, sum(CAST(l_quantity AS BIGINT)) AS quantity
FROM lineitem JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) AS c(code, meaning) ON l_returnflag = c.code
GROUP BY c.code, c.meaning""".replace("sum(CAST(l_quantity AS BIGINT))", "CAST(sum(l_quantity) AS BIGINT)"))
def frame_from_records(t):
    codes = readers.from_records(
        t.spark, [("A", "accepted"), ("N", "none"), ("R", "returned")], "code string, meaning string"
    )
    totals = t.lineitem.groupBy(F.col("l_returnflag").alias("code")).agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
    return totals.join(codes, "code").select("code", "meaning", "quantity")


@query("p03_generated_schema", "SELECT vec_id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64)) + " FROM embeddings")
def generated_schema(t):
    line = F.array_join(F.col("embedding").cast("array<double>").cast("array<string>"), ",")
    parsed = F.from_csv(line, schemas.numbered(64, DoubleType()).simpleString()[len("struct<"):-1].replace(":", " "))
    return t.embeddings.select("vec_id", parsed.alias("r")).select("vec_id", "r.*")


@query("p04_schema_table", "\nUNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS column_type, true AS nullable, count({name}) AS n_values FROM lineitem"
    for i, (name, kind) in enumerate([
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
        ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
    ])))
def schema_table(t):
    return catalog.schema_table(t.lineitem)


@query("p05_alias", "SELECT c.c_custkey, c.c_name, c.c_acctbal FROM customer c")
def alias(t):
    c = t.customer.alias("c")
    return c.select(t.customer.c_custkey, F.col("c.c_name"), c.c_acctbal)


@query("p06_select", "SELECT c_custkey, c_mktsegment, c_nationkey, c_acctbal FROM customer")
def select(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")


@query("p07_star", "SELECT n.*, r.r_name, r.r_regionkey, count(c_custkey) AS customers FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def star(t):
    n, r = t.nation.alias("n"), t.region.alias("r")
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    wide = n.join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey")).select("n.*", "r.r_name", "r.r_regionkey")
    joined = wide.join(per_nation, wide.n_nationkey == per_nation.c_nationkey, "left")
    return joined.select(wide["*"], F.coalesce("customers", F.lit(0)).alias("customers"))


@query("p08_computed_column", "SELECT o_orderkey, 2016 - year(o_orderdate) AS years_ago FROM orders")
def computed_column(t):
    return t.orders.select("o_orderkey", (F.lit(2016) - F.year("o_orderdate")).cast("bigint").alias("years_ago"))


@query("p09_map", "SELECT p_partkey + 1 AS next_key, 'part:' || p_name AS tagged FROM part")
def map_elements(t):
    return t.part.select((F.col("p_partkey") + 1).alias("next_key"), text.with_prefix("part:", F.col("p_name")).alias("tagged"))


@query("p10_flat_map", "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents")
def flat_map(t):
    return projection.explode_words(t.documents, "text", keep=["doc_id"])


@query("p11_map_to_array", """
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, w[1] AS first_word, w[len(w)] AS last_word, md5(array_to_string(w, '|')) AS digest
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""")
def map_to_array(t):
    w = F.col("words")
    return projection.word_arrays(t.documents, "text", keep=["doc_id"]).select(
        "doc_id", F.size(w).cast("bigint").alias("n_words"), text.field(w, 0).alias("first_word"),
        text.field(w, -1).alias("last_word"), F.md5(F.array_join(w, "|")).alias("digest"),
    )


@query("p12_map_values", "SELECT l_suppkey AS k, l_quantity * l_quantity AS v FROM lineitem")
def map_values(t):
    pairs = t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("v"))
    return projection.map_values(pairs, "v", F.col("v") * F.col("v"))


@query("p13_keys", "SELECT l_suppkey AS k FROM lineitem")
def keys(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k"))


@query("p13_values", "SELECT l_quantity AS v FROM lineitem")
def values(t):
    return t.lineitem.select(F.col("l_quantity").alias("v"))


@query("p14_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag FROM lineitem")
def drop(t):
    return t.lineitem.drop("l_linenumber", "l_extendedprice", "l_tax", "l_linestatus", "l_shipdate")


@query("p15_with_column", "SELECT vec_id, label, label - 1 AS shifted FROM embeddings")
def with_column(t):
    return t.embeddings.select("vec_id", "label").withColumn("shifted", F.col("label") - 1)


@query("p16_rename", "SELECT p_partkey AS item_id, p_name AS title, p_brand AS maker, p_type AS genre, p_size AS size, p_retailprice AS price FROM part")
def rename(t):
    return projection.rename(t.part, {
        "p_partkey": "item_id", "p_name": "title", "p_brand": "maker",
        "p_type": "genre", "p_size": "size", "p_retailprice": "price",
    })


_DIRTY_SQL = """
dirty AS (
  SELECT l_orderkey, l_partkey, CASE WHEN l_tax = 0 THEN '?' ELSE CAST(l_tax AS VARCHAR) END AS tax,
         CASE WHEN l_discount = 0 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS discount,
         CAST(l_quantity - 25 AS VARCHAR) AS quantity FROM lineitem)"""


def _dirty(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", F.when(F.col("l_tax") == 0, "?").otherwise(F.col("l_tax").cast("string")).alias("tax"),
        F.when(F.col("l_discount") == 0, "n/a").otherwise(F.col("l_discount").cast("string")).alias("discount"),
        (F.col("l_quantity") - 25).cast("string").alias("quantity"),
    )


@query("p17_cast_set", f"WITH {_DIRTY_SQL} SELECT l_orderkey, l_partkey, CASE WHEN tax = '?' THEN 0.0 ELSE TRY_CAST(tax AS DOUBLE) END AS tax, CASE WHEN discount = '?' THEN 0.0 ELSE TRY_CAST(discount AS DOUBLE) END AS discount, CASE WHEN quantity = '?' THEN 0.0 ELSE TRY_CAST(quantity AS DOUBLE) END AS quantity FROM dirty")
def cast_set(t):
    return projection.cast_to_double(_dirty(t), ["tax", "discount", "quantity"], sentinel="?")


@query("p18_by_position", "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem")
def by_position(t):
    return projection.columns_between(t.lineitem, 4, -1)


@query("p19_decode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status,
       CASE isodow(o_orderdate) - 1 WHEN 0 THEN '一' WHEN 1 THEN '二' WHEN 2 THEN '三' WHEN 3 THEN '四' WHEN 4 THEN '五' WHEN 5 THEN '六' WHEN 6 THEN '日' END AS weekday
FROM orders""")
def decode(t):
    statuses = {"F": "finished", "O": "open", "P": "partial"}
    return t.orders.select(
        "o_orderkey", lookup.decode(F.col("o_orderstatus"), statuses).alias("status"),
        lookup.decode(F.weekday("o_orderdate"), lookup.WEEKDAYS).alias("weekday"),
    )


@query("p20_side_by_side", "SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, l_quantity, l_discount FROM lineitem")
def side_by_side(t):
    label = F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0))
    return t.lineitem.select(label.alias("label"), "l_quantity", "l_discount")


@query("p21_denormalise", "SELECT l_orderkey, l_partkey, l_discount * 100.0 AS l_discount, l_tax * 67.0 AS l_tax FROM lineitem")
def denormalise(t):
    return t.lineitem.select("l_orderkey", "l_partkey", *lookup.denormalise({"l_discount": 100, "l_tax": 67}))


@query("p22_dense_index", "SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS idx FROM (SELECT DISTINCT p_name FROM part)")
def dense_index(t):
    return positions.dense_index(t.part, "p_name")


@query("p23_lookup_title", "SELECT p_partkey, p_brand FROM part WHERE p_name = 'red widget'")
def lookup_title(t):
    return t.part.filter(F.col("p_name") == "red widget").select("p_partkey", "p_brand")


@query("w03_distinct_values_index", "SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS idx FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def distinct_values_index(t):
    return positions.dense_index(t.lineitem, "l_partkey")


@query("x01_split", f"""
SELECT f[1] AS f0, f[2] AS f1, f[3] AS f2, f[4] AS f3, CAST(len(f) AS BIGINT) AS n
FROM (SELECT string_split({_USER_LINE}, '|') AS f FROM customer)""")
def split(t):
    f = F.col("f")
    return _user_fields(t).select(*[text.field(f, i).alias(f"f{i}") for i in range(4)], F.size(f).cast("bigint").alias("n"))


@query("x02_strip_quotes", "SELECT page_id, replace(html, '\"', '') AS html FROM pages")
def strip_quotes(t):
    return t.pages.select("page_id", text.strip_quotes(F.col("html")).alias("html"))


@query("x03_concat_format", """
SELECT c_custkey, 'segment:' || c_mktsegment AS tagged, printf('%.2f', c_acctbal) AS balance FROM customer""")
def concat_format(t):
    return t.customer.select(
        "c_custkey", text.with_prefix("segment:", F.col("c_mktsegment")).alias("tagged"),
        F.format_string("%.2f", "c_acctbal").alias("balance"),
    )


@query("x04_elements", f"""
SELECT f[1] AS first_field, f[len(f)] AS last_field, array_to_string(f[2:len(f) - 1], '+') AS middle
FROM (SELECT string_split({_USER_LINE}, '|') AS f FROM customer)""")
def elements(t):
    f = F.col("f")
    return _user_fields(t).select(
        text.field(f, 0).alias("first_field"), text.field(f, -1).alias("last_field"),
        F.array_join(text.field_slice(f, 1, -1), "+").alias("middle"),
    )


@query("x05_parse", f"WITH {_DIRTY_SQL} SELECT l_orderkey, TRY_CAST(tax AS DOUBLE) AS tax, CAST(TRY_CAST(quantity AS DOUBLE) AS BIGINT) AS quantity, TRY_CAST(discount AS DOUBLE) AS discount FROM dirty")
def parse(t):
    return _dirty(t).select(
        "l_orderkey", numeric.to_double(F.col("tax")).alias("tax"),
        numeric.to_double(F.col("quantity")).cast("bigint").alias("quantity"),
        numeric.to_double(F.col("discount")).alias("discount"),
    )


@query("x06_sentinel", f"WITH {_DIRTY_SQL} SELECT l_orderkey, CASE WHEN tax = '?' THEN 0.0 ELSE TRY_CAST(tax AS DOUBLE) END AS tax, CASE WHEN discount = '?' THEN 0.0 ELSE TRY_CAST(discount AS DOUBLE) END AS discount FROM dirty")
def sentinel(t):
    return _dirty(t).select(
        "l_orderkey", numeric.sentinel_to_zero(F.col("tax")).alias("tax"),
        numeric.sentinel_to_zero(F.col("discount")).alias("discount"),
    )


@query("x07_clamp", "SELECT l_orderkey, greatest(l_quantity - 25, 0.0) AS quantity FROM lineitem")
def clamp(t):
    return t.lineitem.select("l_orderkey", numeric.clamp_negative(F.col("l_quantity") - 25).alias("quantity"))


@query("x08_arithmetic", "SELECT p_partkey, p_size + 1 AS plus_one, p_size - 1 AS minus_one, p_size * p_size AS squared, p_size % 2 AS parity, -p_size AS negated FROM part")
def arithmetic(t):
    s = F.col("p_size")
    return t.part.select(
        "p_partkey", (s + 1).alias("plus_one"), (s - 1).alias("minus_one"), (s * s).alias("squared"),
        (s % 2).alias("parity"), (-s).alias("negated"),
    )


@query("x09_power_root_abs_int", """
SELECT p_partkey, pow(CAST(p_size AS DOUBLE), 2.0) AS squared, round(sqrt(p_retailprice), 6) AS root, abs(p_size - 25) AS distance,
       CAST(trunc(p_retailprice) AS BIGINT) AS whole, CAST(trunc(-p_retailprice) AS BIGINT) AS negative_whole FROM part""")
def power_root_abs_int(t):
    price = F.col("p_retailprice")
    return t.part.select(
        "p_partkey", F.pow("p_size", F.lit(2)).alias("squared"), F.round(F.sqrt(price), 6).alias("root"),
        F.abs(F.col("p_size") - 25).alias("distance"), numeric.truncate(price).alias("whole"),
        numeric.truncate(-price).alias("negative_whole"),
    )


@query("x10_conditional", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM orders")
def conditional(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("parity"))


@query("x11_one_hot_concat", """
SELECT e.vec_id, CAST(s.slot AS INTEGER) AS slot,
       CASE WHEN s.slot < 10 THEN CASE WHEN s.slot = e.label THEN 1.0 ELSE 0.0 END ELSE CAST(e.embedding[s.slot - 9] AS DOUBLE) END AS value
FROM embeddings e, (SELECT unnest(range(0, 74)) AS slot) s""")
def one_hot_concat(t):
    features = F.concat(numeric.one_hot(F.col("label"), 10), F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", F.posexplode(features).alias("slot", "value"))


@query("x12_digit_code", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS code FROM orders")
def digit_code(t):
    return t.orders.select("o_orderkey", numeric.to_double(F.substring("o_orderpriority", 1, 1)).alias("code"))


@query("x13_label_shift", "SELECT vec_id, CAST(label + 1 AS DOUBLE) - 1 AS label FROM embeddings")
def label_shift(t):
    return t.embeddings.select("vec_id", numeric.shift_label((F.col("label") + 1).cast("double")).alias("label"))


@query("d01_arrow_function", f"WITH {_DIRTY_SQL} SELECT l_orderkey, l_partkey, CASE WHEN tax = '?' THEN 0.0 ELSE CAST(tax AS DOUBLE) END AS tax FROM dirty")
def arrow_function(t):
    replace_mark = vectorised.sentinel_text_udf("?", "0")
    return _dirty(t).select("l_orderkey", "l_partkey", replace_mark(F.col("tax")).cast("double").alias("tax"))


@query("d02_batch_function", "SELECT p_partkey, 'part:' || upper(p_name) AS tagged FROM part")
def batch_function(t):
    def tag(batch):
        return batch.assign(tagged="part:" + batch["p_name"].str.upper())[["p_partkey", "tagged"]]

    return vectorised.map_batches(t.part.select("p_partkey", "p_name"), tag, "p_partkey bigint, tagged string")
