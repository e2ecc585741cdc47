"""Files to triage log, on sample tables written out as CSV."""

import datetime as dt

import pytest

from cohortflow.plans.full_run import build_models, run_all
from cohortflow.plans.quality import QualityError
from cohortflow.samples.queries import Star
from cohortflow.samples.rule_scorer import rule_scorer
from cohortflow.samples.star_tables import AS_OF
from cohortflow.sources.tables import rebuild

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date.fromisoformat(AS_OF)


@pytest.fixture()
def folder(spark, databases, tmp_path):
    star = Star(spark, SF_DIR)
    for name in ("patients", "encounters", "conditions", "observations", "medications"):
        df = star.raw(name)
        if name == "encounters":
            df = df.where("patient is not null")  # a run must pass its checks
        if "loaded_at" in df.columns:
            df = df.drop("loaded_at")
        df.coalesce(2).write.option("header", True).option("escape", '"').csv(str(tmp_path / f"{name}.csv"))
    return str(tmp_path)


def test_run_twice(spark, folder):
    first = run_all(spark, folder, rule_scorer, DAY)
    assert not first.load.missing and first.triage.processed == 50
    tables = {n: spark.table(f"analytics.{n}").count() for n in ("dim_patients", "fct_clinical_events", "high_risk_flag")}
    assert tables["dim_patients"] == spark.table("raw.patients").count()
    assert tables["fct_clinical_events"] == spark.table("stg_encounters").count()
    star = Star(spark, SF_DIR)
    # The log holds the ids the sample query lists: same tables, by way of files.
    want = {r[0] for r in star.high_risk().select("patient_id").collect()}
    assert {r[0] for r in spark.table("analytics.high_risk_flag").select("patient_id").collect()} == want

    second = run_all(spark, folder, rule_scorer, DAY)
    assert (second.triage.processed, second.triage.skipped) == (0, 50)
    by_table = {t.table: t.inserted for t in second.load.tables}
    assert by_table["raw.patients"] == by_table["raw.encounters"] == 0 < by_table["raw.conditions"]
    assert spark.table("analytics.triage_summaries").count() == 50
    assert spark.table("analytics.fct_clinical_events").count() == tables["fct_clinical_events"]


def test_rebuild_replaces_rows_and_follows_changed_columns(spark, databases):
    for df in (spark.range(3), spark.range(5), spark.range(2).selectExpr("id", "cast(id as string) as name")):
        back = rebuild(df, "analytics.some_model")
        assert back.columns == df.columns and sorted(back.collect()) == sorted(df.collect())


@pytest.mark.parametrize("columns", ["id", "id, cast(id as string) as name"])
def test_a_failing_rebuild_leaves_the_old_rows(spark, databases, columns):
    rebuild(spark.range(5), "analytics.kept_model")
    broken = spark.range(3).selectExpr(*[c for c in columns.split(", ")]).where("assert_true(id < 2) is null")
    with pytest.raises(Exception, match="(?i)assert|is not true"):
        rebuild(broken, "analytics.kept_model")
    assert sorted(r[0] for r in spark.table("analytics.kept_model").collect()) == [0, 1, 2, 3, 4]


def test_a_failed_check_stops_before_triage(spark, databases, tmp_path):
    (tmp_path / "patients.csv").write_text("Id,BIRTHDATE\np1,2030-01-01\n")

    def never():
        raise AssertionError("scored")

    with pytest.raises(QualityError, match="stg_patients.age >= 0"):
        run_all(spark, str(tmp_path), never, DAY)
    assert build_models(spark, DAY)["dim_patients"].count() == 1


def names(spark):
    return sorted(r["tableName"] for r in spark.sql("show tables in analytics").collect() if "model" in r["tableName"])


def test_a_model_is_swapped_in_one_step(spark, databases):
    """Readers that began on the old version end on it; the one before that is gone."""
    for n in (3, 4):
        rebuild(spark.range(n), "analytics.swapped_model")
    began = spark.table("analytics.swapped_model")
    rebuild(spark.range(5), "analytics.swapped_model")
    assert (began.count(), spark.table("analytics.swapped_model").count()) == (4, 5)
    versions = [f"swapped_model__v{n:08d}" for n in (2, 3)]
    assert names(spark) == ["swapped_model", *versions]


def test_what_a_killed_rebuild_left_goes_with_the_next(spark, databases):
    rebuild(spark.range(3), "analytics.cut_model")
    spark.sql("create table analytics.cut_model__v00000002 (id bigint) using parquet")
    assert spark.table("analytics.cut_model").count() == 3
    rebuild(spark.range(4), "analytics.cut_model")
    assert spark.table("analytics.cut_model").count() == 4
    assert names(spark) == ["cut_model", "cut_model__v00000001", "cut_model__v00000003"]


def test_a_table_of_earlier_days_becomes_a_view(spark, databases):
    spark.range(2).write.saveAsTable("analytics.early_model")
    rebuild(spark.range(6), "analytics.early_model")
    assert spark.table("analytics.early_model").count() == 6
    assert spark.catalog.getTable("analytics.early_model").tableType == "VIEW"
