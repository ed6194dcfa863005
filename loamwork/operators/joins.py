"""Joins on keys.

Plain equi-joins are left to Catalyst: adaptive execution turns a small shuffled side into a broadcast from
its measured size and splits skewed partitions. Two things it cannot do are done here. A hot key on the
nullable side of an outer join is never split, so that join is written as matches plus unmatched rows; and
an aggregate above a join is pushed below it, so that a hot key crosses the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 32 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame as rows in memory: a word per column, null or not, and the bytes of text and nested values."""
    def beyond(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.octet_length(column)
        return F.octet_length(F.to_json(F.struct(column))) if kind.startswith(("array", "map", "struct")) else F.lit(0)

    row_size = sum((F.coalesce(beyond(n, k), F.lit(0)).cast("bigint") + 8 for n, k in df.dtypes), F.lit(8))
    return df.agg(F.coalesce(F.sum(row_size), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the frame; a larger one is left to a shuffle join.

    The frame is computed once to be measured and once to be joined: pass a table, or a stored or cached frame.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def lookup_join(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach a dimension that has one row per key."""
    return facts.join(broadcast_if_small(dimension, limit), list(on), how)


def matched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every matching pair; duplicates on either side multiply."""
    return left.join(right, list(on), "inner")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows whose key is absent on the right. The right side is reduced to its keys first."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def _distinct_names(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    both = {c for c in left.columns if c not in on} & {c for c in right.columns if c not in on}
    if both:
        raise ValueError(f"columns {sorted(both)} are on both sides; rename them on one")


def left_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every left row with its matches, or nulls, when the right side may repeat keys.

    Both sides are read and shuffled twice. Where no key is hot, a plain left join is cheaper.
    """
    _distinct_names(left, right, on)
    pairs = matched(left, right, on)
    return pairs.unionByName(anti(left, right, on), allowMissingColumns=True)


def right_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every right row with its matches, or nulls, when either side may repeat keys; see :func:`left_outer`."""
    _distinct_names(left, right, on)
    pairs = matched(left, right, on)
    return pairs.unionByName(anti(right, left, on), allowMissingColumns=True)


def all_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cartesian product, the one operator whose result is every pair."""
    return left.crossJoin(broadcast_if_small(right))


def text_key_join(
    left: DataFrame, text_key: str, right: DataFrame, number_key: str, how: str = "left"
) -> DataFrame:
    """Join a text key to an integer key. Leading zeros are ignored and text that is no number never matches.

    The right side may repeat keys, so a left join is matches plus unmatched rows, which adaptive execution can split.
    """
    keyed = left.withColumn("_number_key", F.col(text_key).try_cast("bigint"))
    on = keyed["_number_key"] == right[number_key].cast("bigint")
    if how != "left":
        return keyed.join(right, on, how).drop("_number_key")
    pairs = keyed.join(right, on).drop("_number_key")
    known = right.select(F.col(number_key).cast("bigint").alias("_number_key")).distinct()
    unmatched = keyed.join(known, "_number_key", "left_anti").drop("_number_key")
    return pairs.unionByName(unmatched, allowMissingColumns=True)


def counts_by_attribute(
    facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str, attribute: str, count: str = "n"
) -> DataFrame:
    """Left join and count per dimension attribute; facts without a match form the null group.

    Facts are counted per key before the join, which keeps the result exact even when a dimension key repeats.
    """
    per_key = facts.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    names = dimension.select(F.col(dimension_key).alias("_dimension_key"), attribute)
    joined = per_key.join(names, F.col("_key") == F.col("_dimension_key"), "left")
    return joined.groupBy(attribute).agg(F.sum("_n").alias(count))
