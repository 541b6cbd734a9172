"""Run registered queries and their SQL twins on the same folder and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return (0, str(v))
    if isinstance(v, float) and math.isnan(v):
        return (0, "nan")
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return (1, f"{float(v):.4f}")
    return (2, str(v))


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_result(df):
    return sorted(df.columns), sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), sorted_rows(columns, cursor.fetchall())
