"""String columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_on(column: Column, delimiter: str) -> Column:
    """Split on a literal delimiter; empty fields are kept."""
    return F.split(column, f"\\Q{delimiter}\\E", -1)


def strip_quotes(column: Column) -> Column:
    return F.replace(column, F.lit('"'), F.lit(""))


def with_prefix(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column)


def field(fields: Column, position: int) -> Column:
    """Element at a zero-based position; negative positions count from the end. Null when absent."""
    return F.try_element_at(fields, F.lit(position + 1 if position >= 0 else position))


def field_slice(fields: Column, start: int, stop: int | None = None) -> Column:
    """Elements ``start`` (zero-based) up to, not including, ``stop``; a negative stop counts from the end."""
    end = F.size(fields) if stop is None else F.lit(stop)
    if stop is not None and stop < 0:
        end = F.size(fields) + stop
    return F.slice(fields, start + 1, F.greatest(end - start, F.lit(0)))


def occurrences(column: Column, needle: str) -> Column:
    """How often a one-character needle occurs."""
    return F.length(column) - F.length(F.replace(column, F.lit(needle), F.lit("")))


def escape_lines(column: Column) -> Column:
    """Line ends as ``\\n`` and ``\\r``, backslashes doubled."""
    doubled = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_lines(column: Column) -> Column:
    """Undo :func:`escape_lines`. Doubled backslashes are set aside first, so that one before an ``n`` stays what it is."""
    parts = F.split(column, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(column.isNotNull(), F.array_join(plain, "\\"))
