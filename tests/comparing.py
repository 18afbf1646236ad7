"""Compare a Spark result with DuckDB's, ignoring row and column order."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


KINDS = {
    "int64": "int",
    "double": "float",
    "string": "text",
    "bool": "bool",
    "date32[day]": "date",
    "timestamp[us]": "ts",
}


def kinds(table) -> dict[str, str]:
    return {f.name: KINDS.get(str(f.type), str(f.type)) for f in table.schema}


def sorted_rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = zip(*columns) if columns else []
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    problems = []
    if kinds(ours) != kinds(theirs):
        problems.append(f"schema: {kinds(ours)} / {kinds(theirs)}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows: {ours.num_rows} / {theirs.num_rows}")
    if not problems:
        a, b = sorted_rows(ours), sorted_rows(theirs)
        wrong = [(x, y) for x, y in zip(a, b) if x != y]
        if wrong:
            problems.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} / {wrong[0][1]}")
    return problems
