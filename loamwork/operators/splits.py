"""Train, validation and test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from loamwork.operators.positions import keys_at


def hash_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key from its MD5 digest, equal on every engine that has MD5."""
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(key: Column, weights: Mapping[str, int]) -> Column:
    """Name of the split a key falls in. Repeatable, and independent of partitioning; weights are integers."""
    bucket = hash_bucket(key, sum(weights.values()))
    names = list(weights)
    chosen = F.lit(names[-1])
    for name, edge in reversed(list(zip(names, accumulate(weights.values())))):
        chosen = F.when(bucket < edge, F.lit(name)).otherwise(chosen)
    return chosen


def split_frames(df: DataFrame, key: Column, weights: Mapping[str, int]) -> dict[str, DataFrame]:
    """One frame per split name, disjoint and together complete."""
    named = df.withColumn("_split", hash_split(key, weights))
    return {name: named.filter(F.col("_split") == name).drop("_split") for name in weights}


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Seeded random split; weights are normalised and sizes are approximate.

    The same rows in the same partitions give the same split: pass a table or a cached frame, or prefer
    :func:`hash_split`, which depends on the key alone.
    """
    return df.randomSplit(list(map(float, weights)), seed)


def leave_range_out(
    df: DataFrame, by: str, order_by: Sequence[str], start: int, stop: int, max_test: int = 0
) -> DataFrame:
    """Add ``split``: the ``start``-th to ``stop``-th row of each key is ``test``, the rest is ``base``.

    Rows are counted in ``order_by`` order, which must identify a row; it also decides which test rows come
    first when ``max_test`` (0 for none) bounds their number. Each key is trimmed to its first ``stop`` rows
    on the map side, and every row is then compared with the first and last test row of its key.
    """
    row_key = F.struct(*[F.col(c) for c in order_by])
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order_by))
    test = (
        df.select(by, *[c for c in order_by if c != by])
        .withColumn("_place", place)
        .filter(F.col("_place") <= stop)
        .filter(F.col("_place") >= start)
    )
    bounds = test.groupBy(F.col(by).alias("_by")).agg(
        F.min(row_key).alias("_first"), F.max(row_key).alias("_last")
    )
    chosen = row_key.between(F.col("_first"), F.col("_last"))
    found = test.count() if max_test > 0 else 0
    if 0 < max_test < found:
        cut = keys_at(test, order_by, [max_test - 1], found)[0]
        last_kept = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, cut)])
        chosen = chosen & (row_key <= last_kept)
    named = F.when(F.coalesce(chosen, F.lit(False)), F.lit("test")).otherwise(F.lit("base"))
    joined = df.join(bounds, F.col(by).eqNullSafe(F.col("_by")), "left")
    return joined.withColumn("split", named).drop("_by", "_first", "_last")


def contiguous_folds(
    df: DataFrame, order_by: Sequence[str], folds: int, block_rows: int | None = None, name: str = "fold"
) -> DataFrame:
    """Add the fold number, from 0, of each row: fold i is the i-th block of rows in ``order_by`` order.

    Blocks hold ``block_rows`` rows, or an equal share of all rows. Rows after the last fixed-size block get the
    number ``folds``, so that no fold tests them. Only the keys are shuffled, to find the
    first key of each fold; rows are then compared with those few keys where they are.
    """
    total = df.count()
    if block_rows is None:
        firsts = [-(-i * total // folds) for i in range(1, folds)]
    else:
        firsts = [i * block_rows for i in range(1, folds + 1)]
    firsts = [p for p in firsts if p < total]
    row_key = F.struct(*[F.col(c) for c in order_by])
    fold = F.lit(0)
    if firsts:
        for number, key in enumerate(keys_at(df, order_by, firsts, total), start=1):
            edge = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, key)])
            fold = F.when(row_key >= edge, F.lit(number)).otherwise(fold)
    return df.withColumn(name, fold.cast("bigint"))


def fold_frames(df: DataFrame, fold: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(base, test) of one fold."""
    return df.filter(F.col(name) != fold).drop(name), df.filter(F.col(name) == fold).drop(name)
