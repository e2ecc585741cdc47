"""Files to triage log: load, models, checks, triage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortflow.operators.scoring import ScorerFactory
from cohortflow.plans import marts, staging
from cohortflow.plans.quality import LOG_CHECKS, check_tables, gate
from cohortflow.plans.triage import BATCH_SIZE, TriageReport, run_triage
from cohortflow.session import staged
from cohortflow.sources.loader import LoadReport, load_folder
from cohortflow.sources.tables import (
    ANSWER_TABLE,
    MART_DATABASE,
    RAW_DATABASE,
    SUMMARY_TABLE,
    create_all,
    publish_views,
    raw_tables,
    rebuild,
)


@dataclass(frozen=True)
class RunReport:
    load: LoadReport
    triage: TriageReport


def build_models(
    spark: SparkSession,
    as_of: dt.date | None = None,
    raw: str = RAW_DATABASE,
    marts_db: str = MART_DATABASE,
) -> dict[str, DataFrame]:
    """Publish the staging views and rebuild the three mart tables.

    The high-risk list reads the dimension and the fact table as written, so
    neither is computed twice. Only flagged patients' medications are aggregated.
    """
    source = raw_tables(spark, raw)
    patients = staging.stg_patients(source["patients"], as_of)
    encounters = staging.stg_encounters(source["encounters"])
    publish_views({"stg_patients": patients, "stg_encounters": encounters})
    dim = rebuild(marts.dim_patients(patients, encounters, as_of), f"{marts_db}.dim_patients")
    events = rebuild(
        marts.fct_clinical_events(encounters, source["conditions"], source["observations"]),
        f"{marts_db}.fct_clinical_events",
    )
    with staged(marts.flagged_patients(dim, events), "flagged") as flagged:
        listed = marts.high_risk_from(flagged, source["medications"], as_of)
        high_risk = rebuild(listed, f"{marts_db}.high_risk_flag")
    return {
        "raw_patients": source["patients"],
        "raw_encounters": source["encounters"],
        "stg_patients": patients,
        "stg_encounters": encounters,
        "dim_patients": dim,
        "fct_clinical_events": events,
        "high_risk_flag": high_risk,
    }


def run_all(
    spark: SparkSession,
    folder: str,
    factory: ScorerFactory,
    as_of: dt.date | None = None,
    raw: str = RAW_DATABASE,
    marts_db: str = MART_DATABASE,
    na_tokens: Sequence[str] = ("",),
    multiline: bool | None = None,
    n: int = BATCH_SIZE,
    partitions: int = 8,
    dedupe: bool = False,
    indexed: bool = False,
) -> RunReport:
    """Each step needs the one before; a failed check stops the run before triage.

    `multiline` is read_csv's, `dedupe` and `indexed` load_folder's; `n` patients are scored,
    `partitions` at a time, and answers survive a run that is killed. The log's own
    checks run last.
    """
    as_of = as_of or dt.date.today()
    create_all(spark, raw, marts_db)
    loaded = load_folder(spark, folder, raw, na_tokens, multiline, dedupe, indexed)
    tables = build_models(spark, as_of, raw, marts_db)
    gate(check_tables(tables))
    log_table = f"{marts_db}.{SUMMARY_TABLE}"
    answers = f"{marts_db}.{ANSWER_TABLE}"
    triage = run_triage(tables["high_risk_flag"], log_table, factory, as_of, n, partitions, answers)
    gate(check_tables({SUMMARY_TABLE: spark.table(log_table)}, LOG_CHECKS))
    return RunReport(loaded, triage)
