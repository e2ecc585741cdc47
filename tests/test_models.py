import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.plans import marts, staging
from cohortflow.schemas import RAW_SCHEMAS, VITALS
from cohortflow.sources.csv_files import typed_by_name

AS_OF = dt.date(2024, 6, 30)
CODE = {name: code for code, name in VITALS.items()}


def raw(spark, table, columns, data):
    """A raw table holding text given for some of its columns."""
    schema = ", ".join(f"{c} string" for c in columns.split())
    return typed_by_name(spark.createDataFrame(data, schema), RAW_SCHEMAS[table])


@pytest.fixture(scope="module")
def world(spark):
    patients = raw(spark, "patients", "id birthdate deathdate first last ssn healthcare_expenses", [
        ("p1", "1950-07-01", None, "JANE", "o'NEIL", "1", "10.50"),
        ("p2", "2000-01-01", None, "bob", None, "2", None),
        ("p3", "1940-01-01", "2020-01-01", "al", "dead", "3", "1"),
        (None, "1940-01-01", None, "no", "id", "4", "1"),
    ])
    encounters = raw(spark, "encounters", "id start stop patient encounterclass total_claim_cost payer_coverage", [
        ("e1", "2023-01-01T10:00:00", "2023-01-01T10:20:30", "p1", "inpatient", "100.10", "40.05"),
        ("e2", "2024-06-01 09:00:00", "2024-06-01 10:00:00", "p1", "wellness", "50", None),
        ("e3", "2024-06-01 09:00:00", None, "p1", "emergency", "20", "20"),
        ("e4", "2019-01-01 00:00:00", None, "p3", "inpatient", "1", "0"),
        (None, "2019-01-01 00:00:00", None, "p1", "x", "1", "0"),
        ("e5", None, None, "p1", "x", "1", "0"),
        ("e6", "2019-01-01 00:00:00", None, None, "x", "1", "0"),
    ])
    conditions = raw(spark, "conditions", "start stop patient encounter code description", [
        ("2023-01-01", None, "p1", "e1", "44", "Diabetes"),
        ("2023-01-01", None, "p1", "e1", "44", "Coronary"),
        ("2023-01-01", None, "p1", "e1", "55", "Asthma"),
        ("2023-01-01", None, "p1", "e1", None, "Unknown"),
        ("2024-06-01", "2099-01-01", "p1", "e2", "77", "Stopped later"),
        ("2024-06-01", None, "p1", "e3", "77", "Open"),
        ("2024-06-01", None, "p1", "e3", "77", "Open"),
    ])
    observations = raw(spark, "observations", "patient encounter code value", [
        ("p1", "e1", CODE["systolic_bp"], "150"), ("p1", "e1", CODE["systolic_bp"], "99"),
        ("p1", "e1", CODE["glucose_mgdl"], "310"), ("p1", "e1", "other", "n/a"),
        ("p1", "e2", CODE["bmi"], "32.1"), ("p9", "e2", CODE["bmi"], "50"), ("p9", "e2", CODE["heart_rate"], "60"),
        ("p1", "e3", CODE["diastolic_bp"], "90"),
    ])
    medications = raw(spark, "medications", "start stop patient description", [
        ("2020-01-01", None, "p1", "Metformin"), ("2024-01-01", "2024-07-01", "p1", "Lisinopril"),
        ("2024-01-01", "2024-06-30", "p1", "Ends today"), ("2024-01-01", "2024-02-01", "p2", "Ended"),
    ])
    p = staging.stg_patients(patients, AS_OF)
    e = staging.stg_encounters(encounters)
    dim = marts.dim_patients(p, e, AS_OF)
    fct = marts.fct_clinical_events(e, conditions, observations)
    return {"p": p, "e": e, "dim": dim, "fct": fct, "cond": conditions, "obs": observations, "med": medications}


def test_staged_patients(world):
    p = world["p"]
    assert rows(p, "patient_id", "first_name", "full_name", "age", "is_deceased") == [
        ("p1", "jane", "Jane O'Neil", 73, False),
        ("p2", "bob", None, 24, False),
        ("p3", "al", "Al Dead", 80, True),
    ]
    assert not {"ssn", "drivers", "passport", "address"} & set(p.columns)
    assert len(p.columns) == 20


def test_staged_encounters(world):
    got = rows(world["e"], "encounter_id", "duration_minutes", "patient_out_of_pocket")
    assert got == [
        ("e1", 20.5, Decimal("60.0500")),
        ("e2", 60.0, None),
        ("e3", None, Decimal("0.0000")),
        ("e4", None, Decimal("1.0000")),
    ]
    assert len(world["e"].columns) == 18


def test_patient_dimension(world):
    got = rows(
        world["dim"],
        "patient_id", "total_encounters", "last_encounter_at", "first_encounter_at",
        "days_since_last_encounter", "total_claim_cost", "total_out_of_pocket",
    )
    assert got == [
        ("p1", 3, dt.datetime(2024, 6, 1, 9), dt.datetime(2023, 1, 1, 10), 29, Decimal("170.1"), Decimal("60.05")),
        ("p2", 0, None, None, None, Decimal(0), Decimal(0)),
        ("p3", 1, dt.datetime(2019, 1, 1), dt.datetime(2019, 1, 1), 2007, Decimal(1), Decimal(1)),
    ]
    assert len(world["dim"].columns) == 25


def test_fact_table_has_one_row_per_encounter(world):
    fct = world["fct"]
    assert fct.columns == [
        "event_id", "encounter_id", "patient_id", "encounter_start", "encounter_stop", "encounter_class",
        "encounter_description", "reasondescription", "total_claim_cost", "patient_out_of_pocket",
        "condition_code", "condition_description", "condition_is_active", *VITALS.values(),
    ]
    assert rows(fct, "encounter_id", "condition_code", "condition_description", "condition_is_active") == [
        ("e1", "44", "Coronary", True),  # equal codes go by description
        ("e2", "77", "Stopped later", False),  # any stop date ends a condition
        ("e3", "77", "Open", True),
        ("e4", None, None, False),
    ]
    assert fct.where(F.col("event_id") != F.md5("encounter_id")).count() == 0


def test_vitals_of_a_shared_encounter_come_from_the_lower_patient_id(world):
    got = rows(world["fct"], "encounter_id", "systolic_bp", "bmi", "heart_rate")
    assert got == [
        ("e1", Decimal(150), None, None), ("e2", None, Decimal("32.1"), None),
        ("e3", None, None, None), ("e4", None, None, None),
    ]
    assert world["fct"].where("diastolic_bp is not null").count() == 1


def test_conditions_distinct_removes_repeats(world):
    assert world["cond"].count() == 7
    assert marts.conditions_distinct(world["cond"]).count() == 6


def test_latest_vitals_is_one_row_and_diastolic_alone_does_not_count(world):
    got = rows(marts.latest_vitals(world["fct"]))
    assert got == [("p1", None, None, Decimal("32.1"), None, dt.datetime(2024, 6, 1, 9))]


def test_latest_encounter_breaks_equal_starts_by_larger_id(world):
    assert rows(marts.latest_encounter(world["fct"]), "patient_id", "recent_encounter_type") == [
        ("p1", "emergency"),
        ("p3", "inpatient"),
    ]


def test_active_conditions_see_one_condition_per_encounter(world):
    assert rows(marts.active_conditions(world["fct"])) == [("p1", 2, "Coronary; Open")]


def test_single_pass_agrees_with_the_separate_summaries(world):
    one = marts.patient_events(world["fct"])
    parts = (
        world["fct"].select("patient_id").distinct()
        .join(marts.active_conditions(world["fct"]), "patient_id", "left")
        .join(marts.latest_vitals(world["fct"]).drop("vitals_recorded_at"), "patient_id", "left")
        .join(marts.latest_encounter(world["fct"]).drop("last_encounter_at"), "patient_id", "left")
    )
    assert rows(one, *sorted(one.columns)) == rows(parts, *sorted(one.columns))


def test_current_medications_compare_text_dates(world):
    got = rows(marts.current_medications(world["med"], AS_OF))
    assert got == [("p1", "Lisinopril; Metformin"), ("p2", None)]


def test_high_risk_list(world):
    flags = marts.risk_flags(world["dim"], world["fct"], world["med"], AS_OF)
    assert rows(flags, "patient_id", "active_condition_count", "is_high_risk") == [
        ("p1", 2, False), ("p2", None, False),
    ]
    listed = marts.high_risk_flag(
        world["dim"], world["fct"], world["med"], AS_OF, marts.RiskRules(conditions_at_least=2)
    )
    assert rows(listed, "patient_id", "is_high_risk", "is_deceased") == [("p1", True, False)]
    assert listed.columns == [
        "patient_id", "full_name", "age", "gender", "is_deceased", "days_since_last_encounter",
        "active_condition_count", "active_conditions", "latest_systolic_bp", "latest_diastolic_bp",
        "latest_bmi", "latest_glucose", "recent_encounter_type", "current_medications", "is_high_risk",
    ]


def test_each_rule_alone_and_its_boundary(spark):
    columns = "n int, latest_systolic_bp decimal(18,4), latest_glucose decimal(18,4), " \
        "latest_bmi decimal(18,4), days_since_last_encounter int, want boolean"  # fmt: skip
    d = Decimal
    cases = [
        (3, None, None, None, None, True), (2, None, None, None, None, False),
        (None, d("160.5"), None, None, None, True), (None, d(160), None, None, None, False),
        (None, None, d(301), None, None, True), (None, None, d(300), None, None, False),
        (None, None, None, d("40.1"), None, True), (None, None, None, d(40), None, False),
        (1, None, None, None, 366, True), (1, None, None, None, 365, False),
        (None, None, None, None, 366, False), (0, None, None, None, 366, False),
        (None, None, None, None, None, False), (0, d(1), d(301), None, None, True),
    ]
    df = spark.createDataFrame(cases, columns).withColumnRenamed("n", "active_condition_count")
    assert df.where(~marts.RiskRules().column().eqNullSafe(F.col("want"))).count() == 0
