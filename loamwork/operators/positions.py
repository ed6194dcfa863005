"""Exact positions in a global order without a single-task window.

Rows are range-partitioned on the order key and sorted within their partition; each partition is numbered on its own and
shifted by the sizes of the partitions before it. One shuffle, one checkpoint, no window over the rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from loamwork.functions.numeric import any_of
from loamwork.workspace import cut_lineage


# Rows of one range, at most on average: a range is sorted by a single task.
_RANGE_ROWS = 4_000_000
# Low bits of monotonically_increasing_id: the place within a partition. The bits above hold the partition.
_PLACE_BITS = 33


def placed(df: DataFrame, order_by: Sequence[str], rows: int = 0) -> DataFrame:
    """The frame with _range and _place, its zero-based place within its range, checkpointed."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(max(usual, -(-rows // _RANGE_ROWS)), *[F.col(c) for c in order_by])
    numbered = cut_lineage(ranged.sortWithinPartitions(*order_by).withColumn("_spot", F.monotonically_increasing_id()))
    return numbered.withColumns({
        "_range": F.shiftright("_spot", _PLACE_BITS), "_place": F.col("_spot").bitwiseAND(2**_PLACE_BITS - 1)
    }).drop("_spot")


def keys_at(
    df: DataFrame, order_by: Sequence[str], positions: Sequence[int], rows: int
) -> list[tuple]:
    """Order keys at zero-based global positions of a frame of ``rows`` rows. Shuffles the key columns only."""
    ranged = placed(df.select(*order_by), order_by, rows)
    sizes = sorted(ranged.groupBy("_range").count().collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    wanted = []
    for position in positions:
        at = bisect_right(starts, position) - 1
        wanted.append((sizes[at][0], position - starts[at]))
    at_spot = any_of([(F.col("_range") == p) & (F.col("_place") == n) for p, n in sorted(set(wanted))])
    found = ranged.filter(at_spot).collect()
    keys = {(r["_range"], r["_place"]): tuple(r[c] for c in order_by) for r in found}
    return [keys[spot] for spot in wanted]


def number_rows(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Add the zero-based global position of every row.

    The order key should identify a row. The ranged rows are checkpointed, since the shifts are only valid for
    the ranges they were counted on. The running sum has one row per range.
    """
    rows = placed(df, order_by, df.count())
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        rows.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_place") + F.col("_start"))
        .drop("_range", "_place", "_start")
    )


def dense_index(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """(value, index) over the distinct values, numbered from 0 in ascending order."""
    return number_rows(cut_lineage(df.select(column).distinct()), [column], name)
