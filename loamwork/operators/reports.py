"""Small result tables behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loamwork.operators.aggregates import count_by


def shares(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """(key, n, percent) with the percentage of all rows."""
    counts = count_by(df, key)
    everything = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / everything, digits))


def transposed_counts(df: DataFrame, key: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts per key laid out as one row with a column per value."""
    counts = count_by(df, key).withColumn("measure", F.lit("n"))
    return counts.groupBy("measure").pivot(key, values).agg(F.first("n")).na.fill(0)
