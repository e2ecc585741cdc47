"""Triage: score the oldest high-risk patients once per day and log the results."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.assessments import RESPONSE_KEYS, framed_json, parse_assessment
from cohortflow.functions.profiles import PROFILE_FIELDS, render_profile
from cohortflow.operators.answers import answer_in_batches, answer_key, answered
from cohortflow.operators.difference import already_stored, new_rows_only
from cohortflow.operators.scoring import ScorerFactory, score_rows
from cohortflow.operators.selection import top_rows
from cohortflow.session import staged
from cohortflow.sources.tables import append_summaries

log = logging.getLogger(__name__)

# Patients per run, columns handed on, and the closing line.
BATCH_SIZE = 50
CANDIDATE_COLUMNS = ["patient_id", *PROFILE_FIELDS]
REPORT_LINE = "Triage complete. Processed={processed}, Skipped={skipped}, Errors={errors}"
SUMMARY_COLUMNS = [
    "patient_id", "risk_score", "risk_label", "summary", "model_used", "prompt_tokens", "completion_tokens",
]


def candidates(high_risk: DataFrame, n: int = BATCH_SIZE) -> DataFrame:
    """The n oldest high-risk patients; an unknown age comes first, equal ages go by id."""
    order = [F.col("age").desc_nulls_first(), F.col("patient_id").asc()]
    return top_rows(high_risk.select(*CANDIDATE_COLUMNS), order, n)


def _done_on(summaries: DataFrame, run_date: dt.date) -> DataFrame:
    # run_date partitions the log, so only that day's files are listed and read.
    return summaries.where(F.col("run_date") == F.lit(run_date).cast("date"))


def pending(chosen: DataFrame, summaries: DataFrame, run_date: dt.date) -> DataFrame:
    """Candidates without a result for run_date. The limit came first, on purpose:
    a second run on one day does not move on to further patients."""
    return new_rows_only(chosen, _done_on(summaries, run_date), ["patient_id"])


def skipped(chosen: DataFrame, summaries: DataFrame, run_date: dt.date) -> DataFrame:
    """Candidates that have a result for run_date already."""
    return already_stored(chosen, _done_on(summaries, run_date), ["patient_id"])


def prompts(profiles: DataFrame) -> DataFrame:
    """(patient_id, prompt) for every row given."""
    return profiles.select("patient_id", render_profile(profiles).alias("prompt"))


def parse_responses(scored: DataFrame) -> DataFrame:
    """Read each raw response; rows that cannot be used carry status 'error' and the reason."""
    raw = F.col("raw_response")
    framed = scored.withColumn("_json", framed_json(raw))
    parsed = framed.withColumn("_a", parse_assessment(raw, F.col("_json")))
    usable = F.col("_a.problem").isNull()
    problem = F.coalesce("scorer_error", "_a.problem")
    return parsed.select(
        "patient_id",
        *[F.when(usable, F.col(f"_a.{key}")).alias(key) for key in RESPONSE_KEYS],
        "model_used",
        "prompt_tokens",
        "completion_tokens",
        F.when(problem.isNull(), "processed").otherwise("error").alias("status"),
        problem.alias("problem"),
    )


def report(statuses: DataFrame) -> DataFrame:
    """One row with the number of processed, skipped and error rows."""
    names = {"processed": "processed", "skipped": "skipped", "error": "errors"}
    return statuses.agg(
        *[F.count_if(F.col("status") == value).alias(name) for value, name in names.items()]
    )


@dataclass(frozen=True)
class TriageReport:
    processed: int
    skipped: int
    errors: int

    def __str__(self) -> str:
        return REPORT_LINE.format(**vars(self))


def keyed_prompts(todo: DataFrame, run_date: dt.date) -> DataFrame:
    """Prompts with the key under which their answers are stored: patient, day and the prompt itself."""
    day = F.lit(run_date).cast("date")
    key = answer_key(F.col("patient_id"), day, F.col("prompt"))
    return todo.select("patient_id", "prompt", day.alias("run_date"), key.alias("answer_key"))


@contextmanager
def _scored(
    todo: DataFrame, factory: ScorerFactory, run_date: dt.date, partitions: int, answers: str | None, batch_rows: int
) -> Iterator[DataFrame]:
    if answers is None:
        with staged(score_rows(todo, factory, partitions=partitions), "scored") as scored:
            yield scored
        return
    with staged(keyed_prompts(todo, run_date), "asked") as asked:
        for stored in answer_in_batches(asked, answers, factory, batch_rows, partitions):
            log.info("%d answers stored", stored)
        # run_date partitions the store: only that day's answers are read.
        yield answered(asked, _done_on(asked.sparkSession.table(answers), run_date))


def run_triage(
    high_risk: DataFrame,
    table: str,
    factory: ScorerFactory,
    run_date: dt.date,
    n: int = BATCH_SIZE,
    partitions: int = 8,
    answers: str | None = None,
    batch_rows: int = 10,
) -> TriageReport:
    """Choose, score, read and log. One scorer call per pending patient, `partitions` at a time.

    The chosen rows and the scorer's answers are each written once before they
    are used, so later steps, retries and the append never score again. With a
    table `answers`, made where it is missing, they are committed to it every
    `batch_rows` rows: a run that is killed, or whose append fails, leaves them
    there, and the next one of that day asks for the rest only. A failing row does
    not stop the others; a failing append counts its rows as errors.
    """
    spark = high_risk.sparkSession
    with staged(candidates(high_risk, n), "candidates") as chosen:
        summaries = spark.table(table)
        already = skipped(chosen, summaries, run_date).count()
        todo = prompts(pending(chosen, summaries, run_date))
        with _scored(todo, factory, run_date, partitions, answers, batch_rows) as scored:
            parsed = parse_responses(scored)
            counts = report(parsed).first()
            processed, errors = counts["processed"], counts["errors"]
            if processed:
                try:
                    append_summaries(
                        parsed.where("status = 'processed'").select(*SUMMARY_COLUMNS), table, run_date
                    )
                except Exception:
                    log.exception("could not append %d results to %s", processed, table)
                    processed, errors = 0, errors + processed
    result = TriageReport(processed, already, errors)
    log.info("%s", result)
    return result
