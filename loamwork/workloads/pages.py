"""Web pages that stay useful or fade: two classes, one category and many numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.functions.lookup import PAGE_TYPES
from loamwork.functions.text import split_on, strip_quotes
from loamwork.learning.scoring import described
from loamwork.operators.projection import cast_to_double
from loamwork.sources.readers import read_delimited, read_lines
from loamwork.workloads.supervised import Fitted, Task, hard_auc


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Header TSV: url, two unused columns, the category, then numbers in which "?" stands for 0.

    Works for labelled files (last column ``label``) and unlabelled ones.
    """
    header = read_lines(spark, path).limit(1).select(split_on(strip_quotes(F.col("value")), "\t").alias("n"))
    names = header.first().n
    ddl = ", ".join(f"`{n}` string" for n in names)
    rows = read_delimited(spark, path, ddl, sep="\t", header=True)
    return cast_to_double(rows.select(names[0], names[3], *names[4:]), names[4:], sentinel="?")


def page_task(rows: DataFrame) -> Task:
    """Category and number columns by position, the label last."""
    return Task([rows.columns[1]], rows.columns[2:-1], rows.columns[-1], hard_auc, larger_is_better=True)


def predict_pages(fitted: Fitted, pages: DataFrame) -> DataFrame:
    """(url, prediction, description) of every page."""
    return described(fitted.transform(pages), PAGE_TYPES, [pages.columns[0]])
