"""Saving and loading fitted models."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F


def save_model(model, path: str, overwrite: bool = False) -> bool:
    """Save a fitted model; ``False`` when the path already holds one and overwriting is off."""
    writer = model.write().overwrite() if overwrite else model.write()
    try:
        writer.save(path)
    except Py4JJavaError as problem:
        if "already exists" not in str(problem.java_exception.getMessage()):
            raise
        return False
    return True


def load_model(kind, path: str):
    """Load a model of class ``kind``, e.g. ``ALSModel`` or ``PipelineModel``."""
    return kind.load(path)


def model_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Class, Spark version, uid and (for factor models) rank from the saved metadata line."""
    line = spark.read.text(f"{path}/metadata")
    wanted = "class string, sparkVersion string, uid string, rank int"
    return line.select(F.from_json("value", wanted).alias("m")).select("m.*")
