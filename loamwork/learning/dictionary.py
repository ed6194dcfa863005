"""Categories as numbers, for columns with more distinct values than a driver holds.

Values are ranked on the cluster: counted map-side, put in order of falling frequency, ties by value, by ranges, and stored. Rows
get their index by a join, a broadcast when the measured dictionary is small and a shuffle otherwise. No value reaches the driver,
only how many there are.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, functions as F

from loamwork.operators.joins import broadcast_if_small
from loamwork.operators.positions import number_rows
from loamwork.workspace import cut_lineage


def ranked_values(df: DataFrame, column: str) -> DataFrame:
    """(value, n, index) of a column's values as text, nulls left out: index 0 is the most frequent value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = cut_lineage(counts.withColumn("_order", -F.col("n")))
    return number_rows(ordered, ["_order", "value"], "index").select("value", "n", "index")


def indexed(df: DataFrame, column: str, values: DataFrame, unseen: str = "keep", name: str | None = None) -> DataFrame:
    """``df`` with the index of ``column`` as a double. Values that the dictionary lacks, and nulls, share the index after the last
    with ``unseen="keep"``, and their rows go with ``"skip"``."""
    if unseen not in ("keep", "skip"):
        raise ValueError("unseen is keep or skip")
    name = name or f"{column}_index"
    listed = broadcast_if_small(values.select(F.col("value").alias("_value"), F.col("index").alias("_index")))
    found = df.join(listed, F.col(column).cast("string") == F.col("_value"), "left" if unseen == "keep" else "inner")
    size = values.count()
    return found.withColumn(name, F.coalesce(F.col("_index"), F.lit(size)).cast("double")).drop("_value", "_index")


def slots(df: DataFrame, column: str, size: int, output: str) -> DataFrame:
    """``df`` with an index column as a sparse vector of ``size`` slots and one for unseen values."""
    encoder = OneHotEncoder(inputCol=column, outputCol=output, dropLast=False, handleInvalid="error")
    # The encoder takes its width from the largest index it is fitted on: one row with that index says it.
    width = df.sparkSession.range(1).select(F.lit(float(size)).alias(column))
    return encoder.fit(width).transform(df)
