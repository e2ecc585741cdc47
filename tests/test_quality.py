import datetime as dt

import pytest
from conftest import rows

from cohortflow.plans.quality import LOG_CHECKS, RUN_CHECKS, Check, QualityError, check_tables, gate
from cohortflow.schemas import SUMMARY_SCHEMA
from cohortflow.sources.tables import append_summaries

DAY = dt.date(2024, 6, 30)


@pytest.fixture()
def tables(spark):
    people = spark.createDataFrame(
        [("a", 1, "x"), ("a", None, "x"), ("b", -2, None), (None, -3, "y"), (None, 4, "y"), ("a", 5, "z")],
        "id string, age int, mail string",
    )
    return {"people": people, "empty": people.where("false")}


def test_counts_per_rule(tables):
    checks = [
        Check("people", "id", "unique"), Check("people", "mail", "unique"), Check("people", "id", "not_null"),
        Check("people", "age", "not_null"), Check("people", "age", ">= 0"),
        Check("empty", "id", "unique"), Check("empty", "id", "not_null"), Check("empty", "age", ">= 0"),
    ]
    assert rows(check_tables(tables, checks)) == sorted(
        [("people", "id", "unique", 1), ("people", "mail", "unique", 2), ("people", "id", "not_null", 2),
         ("people", "age", "not_null", 1), ("people", "age", ">= 0", 2),
         ("empty", "id", "unique", 0), ("empty", "id", "not_null", 0), ("empty", "age", ">= 0", 0)]
    )


def test_row_rules_alone(tables):
    assert rows(check_tables(tables, [Check("people", "age", "> 4"), Check("empty", "age", "not_null")])) == [
        ("empty", "age", "not_null", 0),
        ("people", "age", "> 4", 4),
    ]


def test_gate(tables):
    good = [Check("empty", "id", "unique"), Check("people", "age", "< 10")]
    assert len(gate(check_tables(tables, good))) == 2
    with pytest.raises(QualityError, match=r"people\.id not_null: 2"):
        gate(check_tables(tables, [*good, Check("people", "id", "not_null")]))


def test_run_checks_cover_all_rules():
    kinds = [c.rule for c in RUN_CHECKS]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count(">= 0")) == (7, 11, 2)


def test_the_log_takes_one_result_per_patient_and_day(spark):
    rows = [("p1", DAY), ("p1", DAY), ("p2", DAY), (None, DAY), (None, DAY), ("p2", None)]
    log = spark.createDataFrame(rows, "patient_id string, run_date date")
    got = {(r["column"], r["check"]): r["failures"] for r in check_tables({"triage_summaries": log}, LOG_CHECKS).collect()}
    assert got == {
        ("patient_id", "not_null"): 2, ("run_date", "not_null"): 1, ("patient_id, run_date", "unique"): 1,
    }


def test_a_result_without_patient_is_refused(spark, databases):
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SUMMARY_SCHEMA if f.name not in ("created_at", "run_date"))
    good, bad = ("p1", 1, "LOW", "s", "m", 1, 1), (None, 1, "LOW", "s", "m", 1, 1)
    with pytest.raises(Exception, match="without patient_id"):
        append_summaries(spark.createDataFrame([good, bad], names), "analytics.triage_summaries", DAY)
    with pytest.raises(ValueError, match="run date"):
        append_summaries(spark.createDataFrame([good], names), "analytics.triage_summaries", None)
    assert spark.table("analytics.triage_summaries").count() == 0
