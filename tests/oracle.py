"""Run queries and their SQL side by side and compare them as sorted rows."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = sorted(tuple(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], plain


def compare(spark_df, connection, sql: str) -> str | None:
    """None when equal, else the first difference."""
    found = rows_of(spark_df.columns, spark_df.collect())
    result = connection.execute(sql)
    wanted = rows_of([d[0] for d in result.description], result.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if len(found[1]) != len(wanted[1]):
        return f"{len(found[1])} rows != {len(wanted[1])}"
    differing = [(f, w) for f, w in zip(found[1], wanted[1]) if f != w]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0][0]} != {differing[0][1]}"
    return None
