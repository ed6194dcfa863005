"""Counts of labels per score, which add up over parts, and the areas that follow from them.

A part of the rows, a day or a split, is reduced to (bin, positives, negatives) once. Parts are merged by adding counts, and any area
under ROC follows from the merged counts without going back to the rows. Bins are the scores themselves, which is exact, or steps of
a given width; then the pairs of a positive and a negative in one bin bound the error, which comes with the area.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from loamwork.operators.joins import broadcast_if_small
from loamwork.operators.positions import placed


def score_counts(scored: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score", width: float | None = None) -> DataFrame:
    """(by, bin, positives, negatives): labels above one half are positive. Null scores or labels count nowhere."""
    value = F.col(score).cast("double") if width is None else F.floor(F.col(score) / width) * width
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    # Zero has two signs but is one score.
    return rows.groupBy(*by, (value + F.lit(0.0)).alias("bin")).agg(F.count_if(F.col(label) > 0.5).alias("positives"), F.count_if(F.col(label) <= 0.5).alias("negatives"))


def merged(*counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of all parts together, per group of ``by``; other columns, such as the part's name, are folded."""
    parts = [c.select(*by, "bin", "positives", "negatives") for c in counts]
    return reduce(DataFrame.unionByName, parts).groupBy(*by, "bin").agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))


def area(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, positives, negatives, auc, error) from merged counts; a group of one class has 0.5.

    ``error`` is the share of pairs that fall in one bin, halved: of exact scores these are ties, whose half is part of the definition; of
    bins with a width the true area is at most that far away. Sums run over ranges of the bins: no task sees all of them.
    """
    ordered = placed(counts, [*by, "bin"])
    here = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("_range").agg(F.sum("negatives").alias("_sum"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_start"))
    below = F.col("_start") + F.coalesce(F.sum("negatives").over(here), F.lit(0))
    running = ordered.join(F.broadcast(starts), "_range").withColumn("_below", below)
    # Groups lie one after the other: what lies below a group's first bin is not its own.
    key = [F.col(c) for c in by]
    firsts = running.groupBy(*key).agg(F.min("_below").alias("_first"))
    if by:
        named = firsts.select(*[F.col(c).alias(f"_{c}") for c in by], "_first")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
        running = running.join(broadcast_if_small(named), same)
    else:
        running = running.withColumn("_first", F.lit(0))
    pairs = F.col("positives") * (F.col("_below") - F.col("_first")).cast("double")
    ties = F.col("positives") * F.col("negatives").cast("double") / 2
    sums = running.groupBy(*key).agg(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.sum(pairs + ties).alias("_won"), F.sum(ties).alias("_tied"))
    every = F.nullif(F.col("positives") * F.col("negatives").cast("double"), F.lit(0.0))
    return sums.select(*by, "positives", "negatives", F.coalesce(F.col("_won") / every, F.lit(0.5)).alias("auc"), F.coalesce(F.col("_tied") / every, F.lit(0.0)).alias("error"))
