"""Views, row counts, schemas and cache state of tables."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


class Tables:
    """Parquet tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame

    def sql(self, statement: str, **views: DataFrame) -> DataFrame:
        """Run SQL over the given frames under those names. No view of the session is replaced or left behind."""
        held = {name: f"{name}_{uuid.uuid4().hex}" for name in views}
        for name, view in held.items():
            views[name].createTempView(view)
            statement = re.sub(rf"\b{name}\b", view, statement)
        try:
            return self.spark.sql(statement)
        finally:
            for view in held.values():
                self.spark.catalog.dropTempView(view)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of several tables in one plan."""
    parts = [
        f.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, f in frames.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type, nullable, n_values) with non-null counts, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f"`{f.name}`").alias("n_values"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def cache_report(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Cache state before, during and after a cached count, as one row."""
    # One column shows the state as well as all of them.
    df = df.select(df.columns[0])
    before = df.is_cached
    df.persist(level)
    during, n_rows = df.is_cached, df.count()
    df.unpersist()
    return df.sparkSession.createDataFrame(
        [(before, during, df.is_cached, n_rows)],
        "cached_before boolean, cached_during boolean, cached_after boolean, n_rows bigint",
    )
