"""Global order and top-k. Callers name tie-breakers, so that results are defined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def ordered(df: DataFrame, *by: str | Column) -> DataFrame:
    return df.orderBy(*by)


def first_rows(df: DataFrame, n: int, *by: str | Column) -> DataFrame:
    """The first ``n`` rows in the given order, kept per partition before they are merged."""
    return df.orderBy(*by).limit(n)


def top_per_key(df: DataFrame, keys: Sequence[str], n: int, *by: Column, rank: str = "place") -> DataFrame:
    """The first ``n`` rows of each key. Spark trims each key on the map side, so a hot key stays small."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn(rank, place.cast("bigint")).filter(F.col(rank) <= n)


def best_setting(metrics: DataFrame, metric: str, larger_is_better: bool, position: str = "grid_position") -> DataFrame:
    """The best row of a sweep; ties go to the setting tried first."""
    score = F.col(metric).desc_nulls_last() if larger_is_better else F.col(metric).asc_nulls_last()
    return first_rows(metrics, 1, score, F.col(position))
