"""Scans, sources and sinks (S). Files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from loamwork.functions.text import strip_quotes, unescape_lines
from loamwork.learning import estimators, features, recommend
from loamwork.operators.aggregates import word_count
from loamwork.operators.sorting import first_rows
from loamwork.plans import derived
from loamwork.plans.registry import query
from loamwork.sources import catalog, models, readers, schemas, writers
from loamwork.workspace import fresh_path, held


def _wide(n: int = 64) -> str:
    slots = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(n))
    return f"SELECT {slots}, CAST(label AS DOUBLE) AS f{n} FROM embeddings"


@query("s01_text_lines", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def text_lines(t):
    path = fresh_path(t.spark, "s01")
    writers.write_lines(t.documents.select("text"), path)
    return readers.read_lines(t.spark, path)


@query("s02_inline_collection", """
SELECT w.priority, CAST(w.weight AS INTEGER) AS weight, count(*) AS n
FROM orders o JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1))
     AS w(priority, weight) ON o.o_orderpriority = w.priority
GROUP BY w.priority, w.weight""")
def inline_collection(t):
    rows = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]
    weights = readers.from_records(t.spark, rows, "priority string, weight int")
    counted = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(weights, "priority").select("priority", "weight", "n")


@query("s03_pipe_delimited", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def pipe_delimited(t):
    path = fresh_path(t.spark, "s03")
    users = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    writers.write_delimited(users, path, sep="|")
    return readers.read_delimited(t.spark, path, users.schema, sep="|")


@query("s04_tab_ratings", """
SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
       CAST(1 + l_quantity % 5 AS INTEGER) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def tab_ratings(t):
    path = fresh_path(t.spark, "s04")
    bought = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = bought.select(
        "o_custkey", "l_partkey", (1 + F.col("l_quantity") % 5).cast("int"), F.unix_date(F.col("l_shipdate").cast("date"))
    )
    writers.write_delimited(lines, path, sep="\t")
    return readers.read_delimited(t.spark, path, schemas.RATINGS, sep="\t").drop("rated_at")


@query("s05_header_tsv_quotes", """
SELECT page_id, url, html FROM pages""")
def header_tsv_quotes(t):
    path = fresh_path(t.spark, "s05")
    pages = t.pages.select("page_id", "url", "html")
    writers.write_delimited(pages, path, sep="\t", header=True, quote_all=True, escaped=True)
    return readers.read_delimited(t.spark, path, pages.schema, sep="\t", header=True, escaped=True)


@query("s05_header_tsv_stripped", """
SELECT CAST(page_id AS VARCHAR) AS page_id, url, replace(html, '"', '') AS html FROM pages""")
def header_tsv_stripped(t):
    path = fresh_path(t.spark, "s05s")
    pages = t.pages.select("page_id", "url", strip_quotes("html").alias("html"))
    writers.write_delimited(pages, path, sep="\t", header=True, quote_all=True, escaped=True)
    # Written with every field quoted, so the header line is quoted as well.
    stripped = readers.read_quote_stripped(t.spark, path, ["page_id", "url", "html"], "\t")
    return stripped.withColumn("html", unescape_lines(F.col("html")))


@query("s06_header_csv", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def header_csv(t):
    path = fresh_path(t.spark, "s06")
    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    writers.write_delimited(parts, path, header=True)
    return readers.read_delimited(t.spark, path, parts.schema, header=True)


@query("s07_wide_numeric_csv", _wide())
def wide_numeric_csv(t):
    path = fresh_path(t.spark, "s07")
    line = F.concat(F.col("embedding").cast("array<double>"), F.array(F.col("label").cast("double")))
    writers.write_lines(t.embeddings.select(F.array_join(line.cast("array<string>"), ",")), path)
    return readers.read_delimited(t.spark, path, schemas.numbered(65, DoubleType()))


@query("s08_csv_with_options", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority
FROM orders""")
def csv_with_options(t):
    path = fresh_path(t.spark, "s08")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    writers.write_delimited(t.orders.select(*columns), path, sep="\t", header=True)
    return readers.read_as_strings(t.spark, path, columns, header="true", delimiter="\t")


@query("s09_text_sink_once", """
WITH words AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents),
     counts AS (SELECT word, count(*) AS n FROM words GROUP BY word)
SELECT unnest(string_split(word || chr(9) || CAST(n AS VARCHAR), chr(10))) AS value, 'true,false' AS written
FROM counts""")
def text_sink_once(t):
    path = fresh_path(t.spark, "s09")
    lines = word_count(t.documents, "text").select(writers.joined_fields("word", "n", sep="\t"))
    tries = [writers.write_lines_once(lines, path) for _ in range(2)]
    written = ",".join(str(x).lower() for x in tries)
    return readers.read_lines(t.spark, path).withColumn("written", F.lit(written))


@query("s10_model_sink")
def model_sink(t):
    path = fresh_path(t.spark, "s10")
    data = derived.labelled_documents(t)
    stages = [*features.mixed_features(["lang"], derived.NUMBERS, scale="deviation"), estimators.naive_bayes(1.0)]
    with held(data):
        model = Pipeline(stages=stages).fit(data)
    saved = [models.save_model(model, path), models.save_model(model, path), models.save_model(model, path, True)]
    again = models.load_model(PipelineModel, path)
    before = model.transform(data).select("doc_id", F.col("prediction").alias("before"))
    after = again.transform(data).select("doc_id", F.col("prediction").alias("after"))
    return before.join(after, "doc_id").withColumn("saved", F.lit(",".join(str(s).lower() for s in saved)))


@query("s11_model_source")
def model_source(t):
    path = fresh_path(t.spark, "s11")
    data = recommend.with_int_ids(derived.stored_ratings(t), "user_id", "item_id")
    models.save_model(recommend.train(data, iterations=20), path)
    loaded = models.load_model(ALSModel, path)
    scored = recommend.predict_pairs(loaded, data)
    facts = models.model_metadata(t.spark, path).first()
    return scored.select(
        "user_id", "item_id", "prediction", F.lit(facts["class"]).alias("model_class"), F.lit(facts["rank"]).alias("rank")
    )


@query("s12_temp_view", "SELECT count(*) AS counts FROM customer")
def temp_view(t):
    return t.sql("SELECT count(*) AS counts FROM user_table", user_table=t.customer)


@query("s13_cache_probe", """
SELECT 'memory' AS level, false AS cached_before, true AS cached_during, false AS cached_after, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'memory_and_disk', false, true, false, count(*) FROM lineitem""")
def cache_probe(t):
    levels = {"memory": StorageLevel.MEMORY_ONLY, "memory_and_disk": StorageLevel.MEMORY_AND_DISK}
    reports = [
        catalog.cache_report(t.lineitem, level).select(F.lit(name).alias("level"), "*")
        for name, level in levels.items()
    ]
    return reports[0].unionAll(reports[1])


@query("s14_first_rows", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5""")
def first_customers(t):
    return first_rows(t.customer.select("c_custkey", "c_name", "c_acctbal"), 5, "c_acctbal", "c_custkey")


_COUNTED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query("s15_row_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _COUNTED))
def row_counts(t) -> DataFrame:
    return catalog.row_counts({n: getattr(t, n) for n in _COUNTED})


