"""Queries and their SQL side by side, on whole tables."""

from pathlib import Path

import pytest
from llm.cases import SF_DIR

from cohortflow.llm.queries import QUERIES
from cohortflow.llm.sql import SQL

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from '{Path(SF_DIR)}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    mine = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    theirs = [tuple(r[columns.index(c)] for c in sorted(columns)) for r in result.fetchall()]
    assert mine and sorted(mine, key=str) == sorted(theirs, key=str)
