"""Batch scoring. Every row is scored by the fitted model in a distributed transform."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from loamwork.functions.lookup import (
    HOLIDAYS, HOURLY_UNITS, SEASONS, WEATHER, WEEKDAYS, WORKDAYS, decode, denormalise,
)
from loamwork.functions.numeric import truncate


def described(scored: DataFrame, names: Mapping[int, str], keep: Sequence[str]) -> DataFrame:
    """Predicted class with its description."""
    return scored.select(*keep, "prediction", decode(F.col("prediction"), names).alias("description"))


def marked(scored: DataFrame, label: str = "label") -> DataFrame:
    """Add ``correct``: whether the predicted class is the actual one."""
    return scored.withColumn("correct", F.col(label) == F.col("prediction"))


def regression_report(scored: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """Whole-number prediction, actual value, whether they agree, and the absolute error."""
    whole = truncate(F.col("prediction"))
    return scored.select(
        *keep, whole.alias("predicted"), F.col(label).alias("actual"),
        (whole == F.col(label)).alias("correct"), F.abs(F.col(label) - whole).alias("abs_error"),
    )


def decoded_hours(df: DataFrame) -> DataFrame:
    """Hourly-rental codes as text and scaled weather values in display units; other columns stay."""
    codes = {
        "season": SEASONS, "holiday": HOLIDAYS, "weekday": WEEKDAYS, "workingday": WORKDAYS, "weathersit": WEATHER,
    }
    return df.withColumns(
        {**{c: decode(F.col(c), names) for c, names in codes.items()},
         **dict(zip(HOURLY_UNITS, denormalise(HOURLY_UNITS)))}
    )
