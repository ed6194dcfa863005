"""Hourly bicycle rentals: regression on calendar and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamwork.learning.scoring import decoded_hours, regression_report
from loamwork.sources import schemas
from loamwork.sources.readers import read_delimited
from loamwork.workloads.supervised import Fitted, Task, rmse


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The eleven features and ``cnt``; row number, date, year and the two partial counts are dropped."""
    rows = read_delimited(spark, path, schemas.HOURLY, header=True)
    return rows.drop("instant", "dteday", "yr", "casual", "registered")


RENTALS = Task([], schemas.HOURLY_FEATURES, "cnt", rmse, larger_is_better=False)
# The same with slots of up to 24 values treated as categories.
RENTALS_INDEXED = Task([], schemas.HOURLY_FEATURES, "cnt", rmse, larger_is_better=False, max_categories=24)


def predict_hours(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """Decoded features, whole-number prediction, actual count, agreement and absolute error of every hour."""
    scored = fitted.transform(rows).select(*schemas.HOURLY_FEATURES, "cnt", "prediction")
    return regression_report(decoded_hours(scored), "cnt", schemas.HOURLY_FEATURES)
