"""Mart models: patient dimension, clinical fact table, high-risk list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.aggregates import distinct_count, distinct_text, latest
from cohortflow.functions.dates import as_of_column, days_since, iso_text
from cohortflow.functions.text import surrogate_key
from cohortflow.operators.reshape import pivot_measures
from cohortflow.operators.selection import first_per_key
from cohortflow.operators.text_lists import join_ordered_text
from cohortflow.plans.staging import PATIENT_ATTRIBUTES, PATIENT_MONEY
from cohortflow.schemas import MEASURE_TYPE, VITALS

# Ordering that makes "first condition" unique: the code, then everything else that is shown.
CONDITION_ORDER = ("condition_code", "condition_description", "condition_start", "condition_stop")
# Newest first; equal starts go to the larger encounter id.
ENCOUNTER_ORDER = ("encounter_start", "encounter_id")


# --- patient dimension ------------------------------------------------------


def encounter_stats(encounters: DataFrame) -> DataFrame:
    """Per patient: number of encounters, first and last start, exact money totals."""
    return encounters.groupBy("patient_id").agg(
        F.count("*").alias("total_encounters"),
        F.max("encounter_start").alias("last_encounter_at"),
        F.min("encounter_start").alias("first_encounter_at"),
        F.sum("total_claim_cost").alias("total_claim_cost"),
        F.sum("patient_out_of_pocket").alias("total_out_of_pocket"),
    )


def dim_patients(patients: DataFrame, encounters: DataFrame, as_of=None) -> DataFrame:
    """Every staged patient with encounter statistics; counts and totals are 0 when there are none."""
    today = as_of_column(as_of)

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return patients.join(encounter_stats(encounters), "patient_id", "left").select(
        "patient_id", "full_name", "first_name", "last_name", "birthdate", "deathdate",
        "age", *PATIENT_ATTRIBUTES, "is_deceased", *PATIENT_MONEY,
        or_zero("total_encounters"),
        "last_encounter_at",
        "first_encounter_at",
        days_since(today, F.col("last_encounter_at")).alias("days_since_last_encounter"),
        or_zero("total_claim_cost"),
        or_zero("total_out_of_pocket"),
    )


# --- clinical fact table ----------------------------------------------------


def condition_rows(conditions: DataFrame) -> DataFrame:
    """Renamed, typed condition rows. Active means no stop date, whatever the dates are."""
    return conditions.select(
        F.col("encounter").alias("encounter_id"),
        F.col("patient").alias("patient_id"),
        F.col("start").cast("date").alias("condition_start"),
        F.col("stop").cast("date").alias("condition_stop"),
        F.col("code").alias("condition_code"),
        F.col("description").alias("condition_description"),
        F.col("stop").isNull().alias("is_active"),
    )


def conditions_distinct(conditions: DataFrame) -> DataFrame:
    """Condition rows without the repeats that loading a file twice leaves."""
    return condition_rows(conditions).distinct()


def first_condition(conditions: DataFrame) -> DataFrame:
    """One condition per encounter, by code.

    Takes raw rows: repeats cannot change which row sorts first, so the distinct
    and its seven-column shuffle are not needed here.
    """
    rows = condition_rows(conditions).drop("patient_id")
    return first_per_key(rows, ["encounter_id"], CONDITION_ORDER).select(
        "encounter_id", "condition_code", "condition_description", "is_active"
    )


def observations_wide(observations: DataFrame) -> DataFrame:
    """One row per (encounter, patient) with a column per vital sign."""
    renamed = observations.withColumnsRenamed({"encounter": "encounter_id", "patient": "patient_id"})
    return pivot_measures(renamed, ["encounter_id", "patient_id"], VITALS, MEASURE_TYPE)


def encounter_vitals(observations: DataFrame) -> DataFrame:
    """Vitals keyed by encounter alone: where two patients share one, the lower patient id's."""
    wide = observations_wide(observations)
    return first_per_key(wide, ["encounter_id"], ["patient_id"]).drop("patient_id")


def fct_clinical_events(
    encounters: DataFrame, conditions: DataFrame, observations: DataFrame
) -> DataFrame:
    """Exactly one row per staged encounter, with its first condition and its vitals.

    Both sides are brought to one row per encounter before they are joined, so no
    join multiplies rows and none has a hot key.
    """
    return (
        encounters.join(first_condition(conditions), "encounter_id", "left")
        .join(encounter_vitals(observations), "encounter_id", "left")
        .select(
            surrogate_key(F.col("encounter_id")).alias("event_id"),
            "encounter_id", "patient_id", "encounter_start", "encounter_stop",
            "encounter_class", "encounter_description", "reasondescription",
            "total_claim_cost", "patient_out_of_pocket",
            "condition_code", "condition_description",
            F.coalesce("is_active", F.lit(False)).alias("condition_is_active"),
            *VITALS.values(),
        )
    )


# --- high-risk list ---------------------------------------------------------


def _condition_summaries() -> list[Column]:
    active = F.col("condition_is_active")
    return [
        distinct_count(F.col("condition_code"), active).alias("active_condition_count"),
        distinct_text(F.col("condition_description"), active).alias("active_conditions"),
    ]


def _newest() -> list[Column]:
    return [F.col(name) for name in ENCOUNTER_ORDER]


def _latest_vitals() -> Column:
    """All four vitals from the newest encounter holding any of three (diastolic does not count)."""
    present = (
        F.col("systolic_bp").isNotNull() | F.col("bmi").isNotNull() | F.col("glucose_mgdl").isNotNull()
    )
    vitals = F.struct(
        F.col("systolic_bp").alias("latest_systolic_bp"),
        F.col("diastolic_bp").alias("latest_diastolic_bp"),
        F.col("bmi").alias("latest_bmi"),
        F.col("glucose_mgdl").alias("latest_glucose"),
        F.col("encounter_start").alias("vitals_recorded_at"),
    )
    return latest(vitals, _newest(), present).alias("vitals")


def active_conditions(events: DataFrame) -> DataFrame:
    """Per patient with an active condition: distinct code count and sorted descriptions."""
    active = events.where("condition_is_active")
    return active.groupBy("patient_id").agg(*_condition_summaries())


def latest_vitals(events: DataFrame) -> DataFrame:
    """Per patient with any vitals: the newest such encounter's, taken as one row."""
    found = events.groupBy("patient_id").agg(_latest_vitals()).where("vitals is not null")
    return found.select("patient_id", "vitals.*")


def latest_encounter(events: DataFrame) -> DataFrame:
    """Per patient: class and start of the newest encounter."""
    newest = F.struct(
        F.col("encounter_class").alias("recent_encounter_type"),
        F.col("encounter_start").alias("last_encounter_at"),
    )
    return events.groupBy("patient_id").agg(latest(newest, _newest()).alias("e")).select("patient_id", "e.*")


def patient_events(events: DataFrame) -> DataFrame:
    """The three summaries above in one pass: one scan of the fact table, one shuffle."""
    return (
        events.groupBy("patient_id")
        .agg(
            *_condition_summaries(),
            _latest_vitals(),
            latest(F.col("encounter_class"), _newest()).alias("recent_encounter_type"),
        )
        .select("*", "vitals.*")
        .drop("vitals", "vitals_recorded_at")
    )


def current_medications(medications: DataFrame, as_of=None, every_patient: bool = True) -> DataFrame:
    """Per patient with any medication: those not stopped, newest start first.

    Start and stop are text and compared as text. A stop later than the as-of
    date still counts as current.
    """
    stop = F.col("stop")
    current = stop.isNull() | (stop > iso_text(as_of_column(as_of)))
    return join_ordered_text(
        medications.withColumnRenamed("patient", "patient_id"),
        ["patient_id"],
        text=F.col("description"),
        newest_first=F.col("start"),
        where=current,
        name="current_medications",
        every_key=every_patient,
    )


@dataclass(frozen=True)
class RiskRules:
    """Thresholds of the high-risk rules."""

    # Fixed values.
    conditions_at_least: int = 3
    systolic_above: int = 160
    glucose_above: int = 300
    bmi_above: int = 40
    days_above: int = 365
    conditions_when_overdue: int = 1

    def column(self) -> Column:
        """True when any rule fires; a rule over a NULL does not fire."""
        conditions = F.col("active_condition_count")
        overdue = F.col("days_since_last_encounter") > self.days_above
        fires = (
            (conditions >= self.conditions_at_least)
            | (F.col("latest_systolic_bp") > self.systolic_above)
            | (F.col("latest_glucose") > self.glucose_above)
            | (F.col("latest_bmi") > self.bmi_above)
            | (overdue & (conditions >= self.conditions_when_overdue))
        )
        return F.coalesce(fires, F.lit(False))


# The list's columns before the flag.
LISTED = (
    "patient_id", "full_name", "age", "gender", "is_deceased", "days_since_last_encounter",
    "active_condition_count", "active_conditions",
    "latest_systolic_bp", "latest_diastolic_bp", "latest_bmi", "latest_glucose",
    "recent_encounter_type", "current_medications",
)


def risk_flags(
    patients: DataFrame,
    events: DataFrame,
    medications: DataFrame,
    as_of=None,
    rules: RiskRules = RiskRules(),
) -> DataFrame:
    """Every living patient with conditions, vitals, medications and the risk flag."""
    living = patients.where(~F.col("is_deceased"))
    # The left join supplies the NULL of patients without current medication.
    lists = current_medications(medications, as_of, every_patient=False)
    return (
        living.join(patient_events(events), "patient_id", "left")
        .join(lists, "patient_id", "left")
        .select(*LISTED, rules.column().alias("is_high_risk"))
    )


def high_risk_flag(
    patients: DataFrame,
    events: DataFrame,
    medications: DataFrame,
    as_of=None,
    rules: RiskRules = RiskRules(),
) -> DataFrame:
    """The living patients for whom a rule fires."""
    return risk_flags(patients, events, medications, as_of, rules).where("is_high_risk")


# Ids of at most this many bytes, 40 more a row counted in, are sent to all executors.
IDS_BYTES = 64 << 20


def flagged_patients(patients: DataFrame, events: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """The living patients for whom a rule fires, without their medications, which no rule reads."""
    living = patients.where(~F.col("is_deceased"))
    return living.join(patient_events(events), "patient_id", "left").where(rules.column())


def medications_of(medications: DataFrame, flagged: DataFrame, ids_bytes: int = IDS_BYTES) -> DataFrame:
    """The medication rows of these patients, picked at the scan, before anything is shuffled.

    One small job measures the ids. Where they are too many to send around, all rows are
    returned: the join with the list drops the others later.
    """
    ids = flagged.select(F.col("patient_id").alias("patient"))
    size = ids.agg(F.coalesce(F.sum(F.octet_length("patient") + 40), F.lit(0)).alias("bytes")).first()["bytes"]
    return medications.join(F.broadcast(ids), "patient", "left_semi") if size <= ids_bytes else medications


def high_risk_from(flagged: DataFrame, medications: DataFrame, as_of=None, ids_bytes: int = IDS_BYTES) -> DataFrame:
    """high_risk_flag's rows from flagged_patients's, best written by then, since they are read three times."""
    lists = current_medications(medications_of(medications, flagged, ids_bytes), as_of, every_patient=False)
    return flagged.join(lists, "patient_id", "left").select(*LISTED, F.lit(True).alias("is_high_risk"))
