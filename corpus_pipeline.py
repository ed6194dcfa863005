"""A cleaning pipeline over ``documents``: toxic documents, shared lines, near copies and benchmark leaks go, the rest is mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the docs of the next.
All but the last return the columns of ``documents``.

Null ids and null texts pass through every stage: a null id is a document like others, after all other ids where ids are ordered; a
null text scores as one without matches, has no lines to lose, is no copy and holds no item. Rows that repeat count as copies of each
other. Extra columns come out as they went in, whatever their names, but for the columns that the last stage adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm import decontaminate, jaccard, lines, mixing, toxicity
from loamwork.llm.common import held_out, stored, table, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.3 or more; the model learns from the labels of the training fold."""
    model = toxicity.fit(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    into = unused(docs.columns, "score")
    return toxicity.score(docs, model, into).where(F.col(into) < 0.3).drop(into)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without boilerplate lines, and without documents that had nothing else. ``n_chars`` follows the text."""
    into = unused(docs.columns, "n_removed")
    cleaned, removed = lines.remove_shared_lines(docs, into=into), F.col(into) > 0
    emptied = removed & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.when(removed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.where(~emptied).withColumn("n_chars", changed).drop(into)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its block and slot in the mixture of sources."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The trained and the latent stages have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
