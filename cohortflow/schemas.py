"""Column layouts of the raw tables and of the triage log.

Numbers that are unbounded decimals in the source system are held in decimals
with room for ten or more places. Text with more places than that is an error, never rounded; sums
are exact, and aggregation buffers are still updated in place.
"""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "text": T.StringType(),
    "date": T.DateType(),
    "moment": T.TimestampNTZType(),
    "money": T.DecimalType(28, 10),
    "degrees": T.DecimalType(28, 20),
    "int": T.IntegerType(),
}

# Table layouts, column by column.
RAW_LAYOUTS = {
    "patients": """
        id text, birthdate date, deathdate date, ssn text, drivers text,
        passport text, prefix text, first text, last text, suffix text,
        maiden text, marital text, race text, ethnicity text, gender text,
        birthplace text, address text, city text, state text, county text,
        zip text, lat degrees, lon degrees,
        healthcare_expenses money, healthcare_coverage money, loaded_at moment""",
    "encounters": """
        id text, start moment, stop moment, patient text, organization text,
        provider text, payer text, encounterclass text, code text,
        description text, base_encounter_cost money, total_claim_cost money,
        payer_coverage money, reasoncode text, reasondescription text,
        loaded_at moment""",
    "conditions": """
        start date, stop date, patient text, encounter text, code text,
        description text, loaded_at moment""",
    "observations": """
        date moment, patient text, encounter text, code text, description text,
        value text, units text, type text, loaded_at moment""",
    "medications": """
        start text, stop text, patient text, payer text, encounter text,
        code text, description text, base_cost money, payer_coverage money,
        dispenses int, totalcost money, reasoncode text, reasondescription text,
        loaded_at moment""",
}
SUMMARY_LAYOUT = """
    patient_id text, risk_score int, risk_label text, summary text,
    model_used text, prompt_tokens int, completion_tokens int,
    created_at moment, run_date date"""
RESPONSE_LAYOUT = """
    raw_response text, model_used text, prompt_tokens int, completion_tokens int,
    scorer_error text"""


def struct(layout: str) -> T.StructType:
    """A schema from 'name type' pairs."""
    pairs = [column.split() for column in layout.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


RAW_SCHEMAS = {name: struct(layout) for name, layout in RAW_LAYOUTS.items()}
SUMMARY_SCHEMA = struct(SUMMARY_LAYOUT)
RESPONSE_SCHEMA = struct(RESPONSE_LAYOUT)

# Tables loaded incrementally, with their key.
PRIMARY_KEYS = {"patients": "id", "encounters": "id"}

# Measure code -> output column, and the type measures are held in.
VITALS = {
    "55284-4": "systolic_bp",
    "8462-4": "diastolic_bp",
    "39156-5": "bmi",
    "2339-0": "glucose_mgdl",
    "8867-4": "heart_rate",
    "8310-5": "body_temp_c",
}
MEASURE_TYPE = "decimal(38,10)"
