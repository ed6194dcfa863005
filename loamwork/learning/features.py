"""Feature stages. They are fitted as part of a Pipeline, on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from loamwork.functions.numeric import shift_label


def indexer(columns: Sequence[str], unseen: str = "keep") -> StringIndexer:
    """Category to index, most frequent first, ties alphabetical. Unseen values share one extra index."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns],
        handleInvalid=unseen, stringOrderType="frequencyDesc",
    )


def encoder(columns: Sequence[str]) -> OneHotEncoder:
    """One slot per category, none dropped."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_slots" for c in columns],
        dropLast=False,
    )


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def scaler(center: bool, source: str = "assembled", output: str = "features") -> StandardScaler:
    """Divide by the sample deviation; ``center`` also subtracts the mean (and makes vectors dense)."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=center, withStd=True)


def category_slots(max_categories: int = 24, source: str = "assembled", output: str = "features") -> VectorIndexer:
    """Mark vector slots with few values as categorical; new values get a category of their own."""
    return VectorIndexer(
        inputCol=source, outputCol=output, maxCategories=max_categories, handleInvalid="keep"
    )


def mixed_features(
    categories: Sequence[str], numbers: Sequence[str], scale: str | None = None, unseen: str = "keep"
) -> list:
    """Stages for one-hot categories followed by numeric columns; ``scale`` is None, "standard" or "deviation"."""
    inputs = [f"{c}_slots" for c in categories] + list(numbers)
    stages: list = [indexer(categories, unseen), encoder(categories)] if categories else []
    if scale is None:
        return [*stages, assembler(inputs)]
    return [*stages, assembler(inputs, "assembled"), scaler(center=scale == "standard")]


def labelled_points(df: DataFrame, label: str | Column, features: str = "features", keep: Sequence[str] = (),
                    shift: int = 0) -> DataFrame:
    """(label, features) rows, the label as double and shifted to start at zero."""
    value = F.col(label) if isinstance(label, str) else label
    return df.select(*keep, shift_label(value, shift).cast("double").alias("label"), F.col(features).alias("features"))


def vector_rows(df: DataFrame, keep: Sequence[str], features: str = "features") -> DataFrame:
    """Vector column in long form: (slot, value) rows next to the kept columns."""
    return df.select(*keep, F.posexplode(vector_to_array(features)).alias("slot", "value"))
