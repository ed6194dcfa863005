"""Set operations over whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on both sides, once each. One grouping over both sides folds copies before they are shuffled."""
    sides = left.withColumn("_side", F.lit(1)).unionAll(right.withColumn("_side", F.lit(2)))
    seen = sides.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.bit_or("_side").alias("_seen"))
    return seen.filter(F.col("_seen") == 3).drop("_seen")


def subtract_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows whose value is absent on the right; left duplicates stay and nulls compare equal."""
    others = right.distinct().toDF(*[f"_{c}" for c in left.columns])
    same = [left[c].eqNullSafe(others[f"_{c}"]) for c in left.columns]
    return left.join(others, reduce(lambda a, b: a & b, same), "left_anti")
