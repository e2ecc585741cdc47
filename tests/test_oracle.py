"""Every registered query against an independent SQL engine, on whole tables."""

import datetime as dt
import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as driver  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortflow.samples import queries  # noqa: E402
from cohortflow.samples.oracle import BODIES  # noqa: E402
from cohortflow.samples.queries import PLANS, build  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES, SQL = driver.queries(), driver.oracle_sql()
SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def ordered(rows):
    def key(row):
        return [(v is None, v.isoformat() if isinstance(v, dt.date) else str(v)) for v in row]

    return sorted(rows, key=key)


def test_every_query_has_its_sql():
    assert set(PLANS) == set(BODIES)


def differs(spark, other, name):
    df = build(name)(spark, SF_DIR)
    names = sorted(df.columns)
    mine = [tuple(row[c] for c in names) for row in df.collect()]
    result = other.execute(SQL[name])
    places = [[d[0] for d in result.description].index(c) for c in names]
    return ordered(mine) != ordered([tuple(row[i] for i in places) for row in result.fetchall()])


def test_a_changed_threshold_or_check_shows(spark, other, monkeypatch):
    assert not differs(spark, other, "quality_report")
    monkeypatch.setattr(queries.marts.RiskRules, "column", lambda self: F.lit(True))
    assert differs(spark, other, "high_risk_flag")
    monkeypatch.setattr(queries, "RUN_CHECKS", queries.RUN_CHECKS[1:])
    assert differs(spark, other, "quality_unique")


@pytest.mark.parametrize("name", list(PLANS))
def test_same_rows(spark, other, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    mine = [tuple(row[c] for c in names) for row in df.collect()]
    result = other.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(types) == names
    assert types == {c: SQL_TYPES[t] for c, t in df.dtypes}
    places = [[d[0] for d in result.description].index(c) for c in names]
    theirs = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert mine, "an empty result checks nothing"
    assert ordered(mine) == ordered(theirs)


def test_entry(spark):
    df = driver.entry(spark)
    assert "is_high_risk" in df.columns and df.count() > 0
