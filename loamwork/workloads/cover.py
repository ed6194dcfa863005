"""Forest cover: seven classes over 54 numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from loamwork.functions.numeric import shift_label
from loamwork.learning.scoring import marked
from loamwork.operators.projection import rename
from loamwork.sources import schemas
from loamwork.sources.readers import read_delimited
from loamwork.workloads.supervised import Fitted, Task, accuracy

WIDTH = 55


def read_cover(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Columns ``f0`` to ``f53`` and a label from 0; the file counts classes from 1 in its last column."""
    rows = read_delimited(spark, path, schemas.numbered(WIDTH, DoubleType()), header=header)
    last = f"f{WIDTH - 1}"
    return rows.withColumn("label", shift_label(F.col(last))).drop(last)


COVER = Task([], [f"f{i}" for i in range(WIDTH - 1)], "label", accuracy, larger_is_better=True)


def predict_cover(fitted: Fitted, rows: DataFrame) -> DataFrame:
    """Every row with its named leading measurements, the prediction, and whether it is right."""
    scored = marked(fitted.transform(rows))
    return rename(scored.select(*schemas.COVER_NAMES, "label", "prediction", "correct"), schemas.COVER_NAMES)
