"""Word count over text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamwork.operators.aggregates import word_count
from loamwork.sources.readers import read_lines
from loamwork.sources.writers import joined_fields, write_lines_once


def count_words(spark: SparkSession, source: str) -> DataFrame:
    """(word, n) over all lines of a file or folder."""
    return word_count(read_lines(spark, source), "value")


def save_counts(counts: DataFrame, target: str) -> bool:
    """Write tab-separated counts as text; ``False`` when the target exists."""
    return write_lines_once(counts.select(joined_fields("word", "n", sep="\t")), target)
