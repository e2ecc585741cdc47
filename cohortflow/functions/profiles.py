"""Patient profile text handed to the scorer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The profile layout, and per field the text for an absent column.
PROFILE_LAYOUT = """\
Patient profile:
- Name: %s
- Age: %s | Gender: %s
- Active conditions: %s
- Current medications: %s
- Recent encounter type: %s
- Days since last encounter: %s

Latest vitals:
- Blood pressure: %s/%s mmHg
- BMI: %s
- Glucose: %s mg/dL

Provide a clinical triage assessment.
"""
PROFILE_FIELDS = {
    "full_name": "Unknown",
    "age": "Unknown",
    "gender": "Unknown",
    "active_conditions": "None documented",
    "current_medications": "None documented",
    "recent_encounter_type": "N/A",
    "days_since_last_encounter": "N/A",
    "latest_systolic_bp": "?",
    "latest_diastolic_bp": "?",
    "latest_bmi": "?",
    "latest_glucose": "?",
}
NULL_TEXT = "None"
# Fields where NULL and empty text both read as the fallback.
FALLBACK_WHEN_EMPTY = ("active_conditions", "current_medications")


def _field(df: DataFrame, name: str, fallback: str) -> Column:
    if name not in df.columns:
        return F.lit(fallback)
    if name in FALLBACK_WHEN_EMPTY:
        return F.when(F.col(name) != "", F.col(name)).otherwise(fallback)
    dtype = df.schema[name].dataType
    measured = isinstance(dtype, T.DecimalType) and dtype.scale > 0
    # Measures read as floating-point numbers do: 32.1, 165.0.
    text = (F.col(name).cast("double") if measured else F.col(name)).cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def render_profile(df: DataFrame) -> Column:
    """The profile text of each row of df; columns df lacks get their fallback."""
    return F.format_string(
        PROFILE_LAYOUT, *[_field(df, name, fallback) for name, fallback in PROFILE_FIELDS.items()]
    )
