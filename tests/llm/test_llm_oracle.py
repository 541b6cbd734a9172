"""Queries of the text operators against their SQL twins, whole results."""

import duckdb
import pytest
from compare import spark_result, sql_result

from martpulse.llm import oracle, queries


@pytest.mark.parametrize("name", oracle.SQL)
def test_same_result(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    columns, rows = spark_result(queries.ALL[name](spark, small))
    sql_columns, sql_rows = sql_result(con, oracle.SQL[name])
    assert columns == sql_columns
    assert rows and rows == sql_rows
