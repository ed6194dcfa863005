"""Grouping and summaries. Everything combines map-side before it is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamwork.operators.positions import placed
from loamwork.operators.projection import explode_words


def summary(df: DataFrame, column: str) -> DataFrame:
    """Count, sum, mean, population deviation, minimum and maximum in one pass."""
    value = F.col(column)
    return df.agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stdev"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
    )


def count_by(df: DataFrame, *keys: str | Column, count: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, total: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


def word_count(df: DataFrame, text: str, word: str = "word", count: str = "n") -> DataFrame:
    """Occurrences of each space-separated token; the empty string counts as one."""
    return count_by(explode_words(df, text, word=word), word, count=count)


def last_value_by(df: DataFrame, key: str, value: str, sequence: str) -> DataFrame:
    """One row per key with the value that comes last in sequence order."""
    return df.groupBy(key).agg(F.max_by(value, sequence).alias(value))


def group_members(df: DataFrame, key: Column, member: str, key_name: str = "grp") -> DataFrame:
    """Members of each computed group as (group, member, copies) rows.

    Equal members are folded into a count, so a group of any size stays spread over the cluster.
    """
    return df.groupBy(key.alias(key_name), member).agg(F.count(F.lit(1)).alias("copies"))


def group_member_lists(
    df: DataFrame, key: Column, member: str, key_name: str = "grp", list_size: int = 10_000
) -> DataFrame:
    """Members of each computed group as sorted arrays of ``list_size`` elements, the last shorter, numbered by ``part``.

    Part is the member's position in its sorted group, divided by ``list_size``. Equal members are folded; the folded rows are
    range-partitioned by (group, member), so a large group is cut over many ranges, and the positions within each range are
    shifted by the copies of the group in the ranges before it.
    """
    folded = placed(group_members(df, key, member, key_name), [key_name, member])
    sizes = folded.groupBy(F.col(key_name).alias("_key"), F.col("_range").alias("_of")).agg(F.sum("copies").alias("_size"))
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_key", "_of", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_range", key_name).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("copies").over(within), F.lit(0)) + F.col("_shift")
    placed_rows = folded.join(shifts, F.col(key_name).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))).withColumn("_start", start)
    stop = F.col("_start") + F.col("copies")
    parts = placed_rows.withColumn("part", F.explode(F.sequence(
        F.floor(F.col("_start") / list_size).cast("int"), F.floor((stop - 1) / list_size).cast("int")
    )))
    copies = F.least(stop, (F.col("part") + 1) * list_size) - F.greatest("_start", F.col("part") * list_size)
    repeated = F.array_repeat(F.col(member), copies.cast("int"))
    return parts.groupBy(key_name, "part").agg(F.sort_array(F.flatten(F.collect_list(repeated))).alias("members"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    """Pair counts with one column per value of ``columns`` and 0 for absent pairs.

    Values are looked up when not given; Spark refuses more than ``spark.sql.pivotMaxValues`` of them.
    """
    table = df.groupBy(F.col(rows).alias(f"{rows}_{columns}")).pivot(columns, values)
    return table.agg(F.count(F.lit(1))).na.fill(0)


# Which result columns `describe` has, in display order.
_DESCRIBED = ("count", "mean", "stddev", "min", "max")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (column_name, stat, value) with the sample deviation; numeric columns only."""
    measures: Mapping[str, object] = {
        "count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max,
    }
    wide = df.agg(
        *[measures[s](F.col(c)).cast("double").alias(f"{c}__{s}") for c in columns for s in _DESCRIBED]
    )
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("stat"), F.col(f"{c}__{s}").alias("value"))
        for c in columns for s in _DESCRIBED
    ]
    return wide.select(F.inline(F.array(*cells)))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n, smallest, largest, mean) of string columns; the mean is over values that are numbers."""
    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.col(c)).alias("n"),
            F.min(F.col(c)).alias("smallest"),
            F.max(F.col(c)).alias("largest"),
            F.avg(F.col(c).try_cast("double")).alias("mean"),
        ).alias(c)
        for c in columns
    ])
    return wide.select(F.inline(F.array(*[F.col(c) for c in columns])))


def distinct_counts(df: DataFrame, columns: Mapping[str, str], total: str = "n_rows") -> DataFrame:
    """Row count and the number of distinct values of several columns, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.countDistinct(F.col(c)).alias(name) for name, c in columns.items()],
    )


def sum_of_squares(df: DataFrame, expression: Column, name: str = "total") -> DataFrame:
    return df.agg(F.sum(F.pow(expression, F.lit(2))).alias(name))
