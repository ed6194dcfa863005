"""What several operators share: tables, word and shingle columns, folds and stored intermediate results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loamwork.workspace import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: ASCII blanks that separate words.
BLANKS = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) under ``name``, with its SQL twin when there is one."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which its owner sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, and safe when executors are lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sealed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, ``_row``: whatever they are called, none meets a column of the operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def opened(df: DataFrame, columns: list[str], **results: Column) -> DataFrame:
    """The columns sealed in ``_row`` with the results: a result takes the place of a column of its name, others come last."""
    kept = [results.pop(c).alias(c) if c in results else F.col(f"_row.`{c}`").alias(c) for c in columns]
    return df.select(*kept, *[value.alias(name) for name, value in results.items()])


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores after it as long as a column, in any case of letters, has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(key: str = "doc_id") -> Column:
    """True for rows that no model may learn from: crc32 of the key as text, modulo 4, is 2. False for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Words of a text, split at ASCII blanks, A-Z lower-cased; an empty array when there are none."""
    return F.array_remove(F.split(lowered(text), BLANKS), "")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; a plain column would be computed anew wherever a lambda names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(word_hashes: Column, width: int = 5) -> Column:
    """Hashes of all runs of ``width`` words, repeats included; of the whole sequence when it is shorter; empty if empty.

    Takes an array of word hashes. Text differs from text with a chance of error of 2**-64 a pair of shingles.
    """

    def runs(hashes: Column) -> Column:
        n = F.size(hashes)
        return (
            F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < width, F.array(F.xxhash64(hashes)))
            .otherwise(F.transform(
                F.sequence(F.lit(1), n - width + 1), lambda i: F.xxhash64(*[F.element_at(hashes, i + k) for k in range(width)])
            ))
        )

    return bound(word_hashes, runs)


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))
