"""Removal of lines that many sites share.

A line is boilerplate when it stands in documents of at least ``min_sites`` distinct sources. Per line hash a HyperLogLog
sketch of the sources is built by aggregation, map-side first, so a line that every document has crosses the shuffle once
per task. Only lines whose estimate is near the threshold are counted exactly. Boilerplate stays in one document, that with
the smallest doc_id, so that what many copies of a document hold in common is not lost with them.

Lines lie between ``\\n``; blanks around a line do not matter and blank lines always stay. Null text is empty, null source
is no site, a null doc_id comes after all others. Repeated rows keep or lose their lines together, except that one row of
the smallest doc_id keeps them. Extra columns stay as they are, whatever their names; a column that is named like the
number of removed lines is replaced by it, so ask for another name where it is to stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.llm.common import opened, query, sealed, stored, table

_BLANKS = " \t\n\x0b\x0c\r"
#: log2 of the registers of a sketch: a standard error of 1.6 %.
_LG_K = 12
#: Estimates within this factor of the threshold are counted exactly: over ten standard errors.
_NEAR = 1.25


def _hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_BLANKS)))


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, first) of the lines found at ``min_sites`` sources or more; ``first`` is the row that keeps it.

    ``lines`` has line (hash), source, doc_id and row_no.
    """
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), F.col("row_no"))
    sketched = stored(
        lines.groupBy("line").agg(F.hll_sketch_agg("source", _LG_K).alias("sites"), F.min(order).alias("first"))
        .withColumn("about", F.hll_sketch_estimate("sites")).where(F.col("about") * _NEAR >= min_sites).select("line", "first.row_no", "about"),
        "spread-lines",
    )
    sure = sketched.where(F.col("about") > min_sites * _NEAR)
    near = sketched.where(F.col("about") <= min_sites * _NEAR)
    # Distinct pairs first: one row per line, source and task leaves the scan.
    exact = (
        lines.select("line", "source").join(near.select("line"), "line", "left_semi").distinct()
        .groupBy("line").agg(F.count("source").alias("sites")).where(F.col("sites") >= min_sites)
    )
    return sure.select("line", "row_no").unionByName(near.join(exact.select("line"), "line", "left_semi").select("line", "row_no"))


def remove_shared_lines(docs: DataFrame, min_sites: int = 10, into: str = "n_removed") -> DataFrame:
    """``docs`` with shared lines removed from ``text``, and in ``into`` the number of lines that went.

    Texts without shared lines are unchanged; the lines left in others are joined by ``\\n``.
    """
    rows = stored(docs.select(sealed(docs), F.monotonically_increasing_id().alias("row_no")), "line-rows")
    text = F.col("_row.text")
    lines = rows.select(
        F.col("_row.doc_id").cast("bigint").alias("doc_id"), F.col("_row.source").cast("string").alias("source"), "row_no",
        F.posexplode(F.split(text, "\n", -1)).alias("at", "value"),
    ).where(F.btrim("value", F.lit(_BLANKS)) != "").withColumn("line", _hash(F.col("value")))
    shared = stored(boilerplate(lines, min_sites).withColumnRenamed("row_no", "keeper"), "shared-lines")
    gone = (
        lines.select("row_no", "at", "line").join(shared, "line").where(F.col("row_no") != F.col("keeper"))
        .groupBy("row_no").agg(F.collect_set("at").alias("gone"))
    )
    left = F.array_join(F.filter(
        F.transform(F.split(text, "\n", -1), lambda value, at: F.when(~F.array_contains("gone", at), value)), lambda v: v.isNotNull()
    ), "\n")
    return opened(rows.join(gone, "row_no", "left"), docs.columns, **{
        "text": F.when(F.col("gone").isNull(), text).otherwise(left), into: F.coalesce(F.size("gone"), F.lit(0)).cast("bigint"),
    })


@query("op1_line_dedup", """
WITH cut AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, source, unnest(parts) AS value, generate_subscripts(parts, 1) AS place FROM cut
), keyed AS (SELECT *, trim(value, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM lines),
shared AS (SELECT line, min(doc_id) AS keeper FROM keyed WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
marked AS (SELECT k.*, s.line IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.line = s.line)
SELECT doc_id, coalesce(string_agg(value, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text,
       count(*) FILTER (WHERE gone) AS n_removed
FROM marked GROUP BY doc_id""")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_shared_lines(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_removed")
