"""Sinks. A target that exists is never overwritten unless the caller asks for it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from loamwork.functions.text import escape_lines


def write_lines(df: DataFrame, path: str) -> None:
    """Write a one-column string frame as newline-ended text; fails when the path exists."""
    df.write.mode("errorifexists").option("lineSep", "\n").text(path)


def write_lines_once(df: DataFrame, path: str) -> bool:
    """Like :func:`write_lines`, but an existing path is reported as ``False``."""
    try:
        write_lines(df, path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return False
    return True


def write_delimited(
    df: DataFrame, path: str, sep: str = ",", header: bool = False, quote_all: bool = False, escaped: bool = False
) -> None:
    """Write delimited text that :func:`loamwork.sources.readers.read_delimited` reads back unchanged.

    Blanks at the ends of fields are kept. A line end inside a field would split its row: with ``escaped`` it is written as
    ``\\n`` or ``\\r`` and a backslash doubled, to be read with ``escaped`` as well; without it the write fails. Nulls and
    empty strings are both empty fields, which read back as null.
    """
    def safe(name: str):
        column = F.col(f"`{name}`")
        if escaped:
            return escape_lines(column).alias(name)
        broken = column.contains("\n") | column.contains("\r")
        message = F.lit(f"column {name} holds a line end; write it with escaped=True")
        return F.when(broken, F.raise_error(message).cast("string")).otherwise(column).alias(name)

    columns = [safe(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema.fields]
    (
        df.select(*columns).write.mode("errorifexists")
        .options(sep=sep, header=header, quoteAll=quote_all, quote='"', escape='"')
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def joined_fields(*columns: str | Column, sep: str) -> Column:
    """Fields of a row as one delimited string."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(sep, *[p.cast("string") for p in parts])
