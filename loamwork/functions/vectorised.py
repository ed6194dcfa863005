"""The Python function surface: Arrow batches, for logic that built-in expressions cannot state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructType


def sentinel_text_udf(sentinel: str = "?", replacement: str = "0"):
    """String-to-string function over Arrow batches that replaces a missing-value mark."""

    @F.pandas_udf(StringType())
    def replace_mark(values: pd.Series) -> pd.Series:
        return values.mask(values == sentinel, replacement)

    return replace_mark


def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str | StructType
) -> DataFrame:
    """Apply a pandas function to every Arrow batch of every partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
