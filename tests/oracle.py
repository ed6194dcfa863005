"""Run registered queries against their SQL on DuckDB.

``python -m tests.oracle [folder] [name-prefix …]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, connection, query, sql: str, folder: str) -> str:
    """Empty when both results agree, else what differs."""
    frame = query(spark, folder)
    ours = rows_of(frame.columns, frame.collect())
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    kinds = {d[0]: str(d[1]) for d in answer.description}
    theirs = rows_of(names, answer.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in frame.dtypes:
        if kind in wanted and wanted[kind] not in (kinds[name], {"NUMBER": wanted[kind], "STRING": "VARCHAR", "bool": "BOOLEAN"}.get(kinds[name])):
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(folder: str, prefixes: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(folder), 0
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        began = time.perf_counter()
        try:
            if name in oracles:
                problem = compare(spark, connection, query, oracles[name], folder)
            else:
                problem = "" if query(spark, folder).collect() else "no rows"
        except Exception as error:  # noqa: BLE001  (reported per query)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.perf_counter() - began:6.2f}s {name} {problem}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(bool(main(arguments[0], arguments[1:])))
