"""Readers for text and delimited files. Schemas are always explicit, nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from loamwork.functions.text import split_on, strip_quotes, unescape_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``; only a newline ends a line."""
    return spark.read.option("lineSep", "\n").text(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    sep: str = ",",
    header: bool = False,
    mode: str = "FAILFAST",
    escaped: bool = False,
    **options: str,
) -> DataFrame:
    """Delimited file with quoting honoured; doubled quotes stand for one quote.

    A bad number, a short line or a surplus field is an error. ``mode="PERMISSIVE"`` makes nulls of them, with
    ``columnNameOfCorruptRecord`` and a schema column of that name to keep the line. ``escaped`` undoes the escapes of
    :func:`loamwork.sources.writers.write_delimited`.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", mode)
    read = reader.options(**{"quote": '"', "escape": '"', **options}).csv(path)
    if not escaped:
        return read
    return read.select(*[
        (unescape_lines(F.col(f"`{f.name}`")) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")).alias(f.name)
        for f in read.schema.fields
    ])


def read_as_strings(spark: SparkSession, path: str, columns: Sequence[str], **options: str) -> DataFrame:
    """The generic CSV source with caller options; every column stays a string."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("csv").schema(ddl).options(**options).load(path)


def drop_header_lines(lines: DataFrame, header: str, column: str = "value") -> DataFrame:
    """Drop every line equal to the header line."""
    return lines.filter(~F.col(column).eqNullSafe(F.lit(header)))


def read_quote_stripped(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str, header: bool = True
) -> DataFrame:
    """Line-based reading that deletes all double quotes before splitting.

    Quoting is not honoured: a delimiter between quotes shifts the later fields. Short lines give nulls.
    """
    lines = read_lines(spark, path)
    if header:
        lines = drop_header_lines(lines, lines.first()[0])
    fields = split_on(strip_quotes(F.col("value")), sep)
    return lines.select(fields.alias("fields")).select(
        *[F.try_element_at("fields", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)]
    )


def from_records(spark: SparkSession, rows: Iterable[tuple], ddl: str | StructType) -> DataFrame:
    """A small inline table with a declared schema."""
    return spark.createDataFrame(list(rows), ddl)
