"""Staging models: typed, renamed, filtered views of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.dates import as_of_column, completed_years, minutes_between
from cohortflow.functions.text import full_name

# Patient columns that pass through unchanged.
PATIENT_ATTRIBUTES = ["gender", "race", "ethnicity", "marital", "city", "state", "zip", "lat", "lon"]
PATIENT_MONEY = ["healthcare_expenses", "healthcare_coverage"]


def stg_patients(patients: DataFrame, as_of=None) -> DataFrame:
    """One row per patient with an id; direct identifiers are left behind."""
    c = F.col
    end = F.coalesce(c("deathdate"), as_of_column(as_of))
    return patients.where(c("id").isNotNull()).select(
        c("id").alias("patient_id"),
        F.lower("first").alias("first_name"),
        F.lower("last").alias("last_name"),
        full_name(c("first"), c("last")).alias("full_name"),
        "birthdate",
        "deathdate",
        completed_years(c("birthdate"), end).alias("age"),
        *PATIENT_ATTRIBUTES,
        *PATIENT_MONEY,
        c("deathdate").isNotNull().alias("is_deceased"),
        "loaded_at",
    )


def stg_encounters(encounters: DataFrame) -> DataFrame:
    """One row per encounter that has an id, a patient and a start."""
    c = F.col
    usable = c("id").isNotNull() & c("patient").isNotNull() & c("start").isNotNull()
    start = c("start").cast("timestamp_ntz")
    stop = c("stop").cast("timestamp_ntz")
    return encounters.where(usable).select(
        c("id").alias("encounter_id"),
        c("patient").alias("patient_id"),
        "organization",
        "provider",
        "payer",
        c("encounterclass").alias("encounter_class"),
        c("code").alias("encounter_code"),
        c("description").alias("encounter_description"),
        "reasoncode",
        "reasondescription",
        start.alias("encounter_start"),
        stop.alias("encounter_stop"),
        minutes_between(start, stop).alias("duration_minutes"),
        "base_encounter_cost",
        "total_claim_cost",
        "payer_coverage",
        (c("total_claim_cost") - c("payer_coverage")).alias("patient_out_of_pocket"),
        "loaded_at",
    )
