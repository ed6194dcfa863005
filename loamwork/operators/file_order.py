"""Rows numbered in the order of their files, where they carry no key of their own.

A line's place is that of its file, by path, of its split in the file, by the byte where it starts, and of itself in the split. Rows of
a split are read in order by one task, so the place in the split follows from the task's own numbering. What is summed up is one count
per split; no row is shuffled or sorted, and no task sees more than its splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loamwork.operators.joins import broadcast_if_small
from loamwork.operators.positions import number_rows
from loamwork.workspace import cut_lineage

#: More splits than this are numbered by ranges, fewer by one window.
_MANY_SPLITS = 100_000


def in_file_order(read: DataFrame, name: str = "line_number") -> DataFrame:
    """``read`` with the zero-based number of each line in file order.

    ``read`` is a frame straight from a file source, or a selection and filters of it that were made without a shuffle: filtered lines
    are not numbered. The numbered lines are checkpointed, since a place holds for the splits it was counted on.
    """
    columns = [F.col(f"`{c}`") for c in read.columns]
    placed = cut_lineage(read.select(
        *columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_spot")
    ))
    sizes = cut_lineage(placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_size"), F.min("_spot").alias("_first")))
    if sizes.count() <= _MANY_SPLITS:
        before = F.coalesce(F.sum("_size").over(Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sizes.select("_file", "_block", "_first", before.alias("_start"))
    else:
        starts = _by_ranges(sizes)
    numbered = placed.join(broadcast_if_small(starts), ["_file", "_block"])
    return numbered.select(*columns, (F.col("_start") + F.col("_spot") - F.col("_first")).alias(name))


def _by_ranges(sizes: DataFrame, width: int = 1000) -> DataFrame:
    """Starts of very many splits: sums of a thousand splits each, then within them."""
    ranked = cut_lineage(number_rows(sizes, ["_file", "_block"], "_at").withColumn("_group", F.expr(f"_at div {width}")))
    groups = ranked.groupBy("_group").agg(F.sum("_size").alias("_sum"))
    ahead = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("_group", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return ranked.join(F.broadcast(offsets), "_group").select(
        "_file", "_block", "_first", (F.col("_offset") + F.coalesce(F.sum("_size").over(within), F.lit(0))).alias("_start")
    )


def drop_first_lines(read: DataFrame, lines: int = 1) -> DataFrame:
    """``read`` without the first lines of the first file: a header that only the order tells from data."""
    return in_file_order(read, "_line").where(F.col("_line") >= lines).drop("_line")


def file_folds(read: DataFrame, folds: int, name: str = "fold") -> DataFrame:
    """``read`` with the fold of each line: fold i is the i-th block of lines in file order, of equal size but for one line."""
    numbered = in_file_order(read, "_line")
    total = numbered.count()
    return numbered.withColumn(name, F.expr(f"_line * {folds} div {max(total, 1)}")).drop("_line")


def leave_range_out_of_file(read: DataFrame, by: str, start: int, stop: int) -> DataFrame:
    """``read`` with ``split``: the ``start``-th to ``stop``-th line of each key, in file order, is ``test``, the rest ``base``.

    Only the line numbers of a key's first lines are kept to find its range: a window over (key, number) that stops at ``stop``.
    """
    numbered = in_file_order(read, "_line")
    place = F.row_number().over(Window.partitionBy("_by").orderBy("_line"))
    first = numbered.select(F.col(by).alias("_by"), "_line").withColumn("_place", place).where(F.col("_place") <= stop).where(F.col("_place") >= start)
    bounds = first.groupBy("_by").agg(F.min("_line").alias("_low"), F.max("_line").alias("_high"))
    joined = numbered.join(bounds, numbered[by].eqNullSafe(F.col("_by")), "left")
    test = F.coalesce(F.col("_line").between(F.col("_low"), F.col("_high")), F.lit(False))
    return joined.withColumn("split", F.when(test, "test").otherwise("base")).drop("_by", "_line", "_low", "_high")

