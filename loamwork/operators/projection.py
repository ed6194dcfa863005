"""Column selection, renaming, casting and row expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loamwork.functions.numeric import sentinel_to_zero, to_double
from loamwork.functions.text import split_on


def cast_to_double(df: DataFrame, columns: Sequence[str], sentinel: str | None = None) -> DataFrame:
    """Cast the named columns to double, the others stay; a sentinel text becomes 0, junk becomes null."""
    chosen = set(columns)

    def convert(name: str) -> Column:
        if name not in chosen:
            return F.col(name)
        value = F.col(name) if sentinel is None else F.col(name).cast("string")
        return (to_double(value) if sentinel is None else sentinel_to_zero(value, sentinel)).alias(name)

    return df.select(*[convert(c) for c in df.columns])


def columns_between(df: DataFrame, start: int | None, stop: int | None) -> DataFrame:
    """Columns by position, with Python slice bounds."""
    return df.select(*df.columns[start:stop])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def map_values(df: DataFrame, value: str, expression: Column) -> DataFrame:
    """Replace the value column and keep the keys."""
    return df.withColumn(value, expression)


def explode_words(df: DataFrame, text: str, keep: Sequence[str] = (), word: str = "word") -> DataFrame:
    """One row per space-separated token. Runs of spaces give empty tokens, as plain splitting does."""
    return df.select(*keep, F.explode(split_on(F.col(text), " ")).alias(word))


def word_arrays(df: DataFrame, text: str, keep: Sequence[str] = (), words: str = "words") -> DataFrame:
    """The tokens of each row as one array."""
    return df.select(*keep, split_on(F.col(text), " ").alias(words))
