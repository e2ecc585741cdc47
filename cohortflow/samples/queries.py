"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce
from itertools import islice

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators.answers import answer_in_batches, answered
from cohortflow.operators.difference import new_rows_only
from cohortflow.operators.reshape import hashed_count, k_of_n_explode
from cohortflow.operators.scoring import score_rows
from cohortflow.operators.selection import exact_sample, hash_sample
from cohortflow.plans import marts, staging, triage
from cohortflow.plans.quality import LOG_CHECKS, RUN_CHECKS, Check, check_tables, failing_rows
from cohortflow.samples import rule_scorer as scorers
from cohortflow.samples.star_tables import AS_OF, raw_table
from cohortflow.schemas import PRIMARY_KEYS, RAW_SCHEMAS, SUMMARY_SCHEMA, VITALS
from cohortflow.session import kept, remove_path, scratch_database, scratch_path, staged
from cohortflow.sources.csv_files import read_csv, typed_by_name
from cohortflow.sources.loader import load_folder, load_rows
from cohortflow.sources.tables import ANSWER_TABLE, SUMMARY_TABLE, create_all, create_table, summary_preview

# The scorer travels with the job, whether or not the workers have this package.
cloudpickle.register_pickle_by_value(scorers)

RUN_DATE = dt.date.fromisoformat(AS_OF)
# Patients seen before this date count as loaded earlier.
LOADED_BEFORE = "1996-01-01"
# Patients whose newest encounter has this class count as triaged already.
TRIAGED_CLASS = "1-URGENT"
SAMPLE_SEED = "7"


class Star:
    """The sample tables and models of one data folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = raw_table(self.spark, self.sf_dir, f"raw_{name}")
        return self._raw[name]

    def patients(self) -> DataFrame:
        return staging.stg_patients(self.raw("patients"), AS_OF)

    def encounters(self) -> DataFrame:
        return staging.stg_encounters(self.raw("encounters"))

    def dim(self) -> DataFrame:
        return marts.dim_patients(self.patients(), self.encounters(), AS_OF)

    def events(self) -> DataFrame:
        return marts.fct_clinical_events(
            self.encounters(), self.raw("conditions"), self.raw("observations")
        )

    def risk_flags(self) -> DataFrame:
        return marts.risk_flags(self.dim(), self.events(), self.raw("medications"), AS_OF)

    def high_risk(self) -> DataFrame:
        return self.risk_flags().where("is_high_risk")

    def done(self) -> DataFrame:
        """A triage log for the run date: every patient whose newest encounter was urgent."""
        newest = marts.latest_encounter(self.encounters())
        urgent = newest.where(F.col("recent_encounter_type") == TRIAGED_CLASS)
        return urgent.select("patient_id", F.lit(RUN_DATE).alias("run_date"))

    def parsed(self) -> DataFrame:
        return triage.parse_responses(self.raw("responses"))

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_patients": self.raw("patients"),
            "raw_encounters": self.raw("encounters"),
            "raw_conditions": self.raw("conditions"),
            "stg_patients": self.patients(),
            "stg_encounters": self.encounters(),
            "dim_patients": self.dim(),
            "fct_clinical_events": self.events(),
            "high_risk_flag": self.high_risk(),
        }


def doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, at the very end only, so that engines agree on the type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema.fields
        ]
    )


def _new_patients(s: Star) -> DataFrame:
    seen = s.encounters().where(F.col("encounter_start") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    existing = seen.select(F.col("patient_id").alias("id"))
    return new_rows_only(s.raw("patients").select("id", "birthdate", "first", "last"), existing, ["id"])


def _triage_pending(s: Star) -> DataFrame:
    return triage.pending(triage.candidates(s.high_risk()), s.done(), RUN_DATE)


def _triage_skipped(s: Star) -> DataFrame:
    return triage.skipped(triage.candidates(s.high_risk()), s.done(), RUN_DATE)


def _triage_day(s: Star) -> DataFrame:
    scored = score_rows(triage.prompts(_triage_pending(s)), scorers.rule_scorer)
    return triage.parse_responses(scored)


def _triage_report(s: Star) -> DataFrame:
    # The flagged patients are planned once: one left join with the day's log and one with the answers.
    done = s.done().select("patient_id", F.lit(True).alias("is_done"))
    answers = s.parsed().select("patient_id", F.col("status").alias("answer"))
    flagged = s.high_risk().select("patient_id").join(done, "patient_id", "left").join(answers, "patient_id", "left")
    return triage.report(flagged.select(F.when(F.col("is_done"), "skipped").otherwise(F.col("answer")).alias("status")))


def _shouted(df: DataFrame) -> DataFrame:
    """Header names as files from elsewhere bring them."""
    return df.toDF(*[f" {name.upper()} " for name in df.columns])


def _csv_writer(df: DataFrame):
    # Text is written as it is; by default the writer trims it.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return _shouted(df).write.mode("overwrite").options(header=True, escape='"', **kept)


# Per table a key, and a text column in which line breaks, quotes, commas and empty texts are planted.
PLANTED = {
    "patients": ("id", "city"),
    "encounters": ("id", "description"),
    "conditions": ("encounter", "description"),
    "observations": ("encounter", "value"),
    "medications": ("patient", "description"),
}
PLANT = (
    "case length({key}) % 3 when 0 then concat('a', chr(10), ', \"', {text}, '\"') "
    "when 1 then '' else concat('\"', {text}, chr(10)) end"
)


def _line(df: DataFrame, name: str) -> DataFrame:
    """Every row as one text: its values in order, missing ones as a tilde."""
    kinds = RAW_SCHEMAS[name]
    texts = [F.coalesce(F.col(f).cast(kinds[f].dataType).cast("string"), F.lit("~")) for f in df.columns]
    return df.select(F.lit(name).alias("name"), F.concat_ws("|", *texts).alias("line"))


def _csv_roundtrip(s: Star) -> DataFrame:
    """All raw tables, written as CSV with planted text and read back with their types."""
    folder, parts = scratch_path(s.spark, "csv"), []
    for name, (key, text) in PLANTED.items():
        rows = s.raw(name)
        planted = rows.withColumn(text, F.expr(PLANT.format(key=key, text=text)))
        _csv_writer(planted).csv(f"{folder}/{name}")
        try:
            back = typed_by_name(read_csv(s.spark, f"{folder}/{name}"), RAW_SCHEMAS[name])
            # What was read stays, a fraction of the text's size; the text goes before the next table's is written.
            parts.append(_line(kept(back.select(*rows.columns), "read"), name))
        finally:
            remove_path(s.spark, folder)
    return reduce(DataFrame.unionByName, parts)


def _load_twice(s: Star) -> DataFrame:
    """Load CSV files of all raw tables twice: per table, rows inserted each time and rows stored."""
    spark, folder = s.spark, scratch_path(s.spark, "csv")
    with scratch_database(spark, "load") as raw, scratch_database(spark, "marts") as marts_db:
        try:
            for name in RAW_SCHEMAS:
                _csv_writer(s.raw(name)).csv(f"{folder}/{name}.csv")
            create_all(spark, raw, marts_db)
            once, twice = load_folder(spark, folder, raw), load_folder(spark, folder, raw)
            counts = [
                (name, a.inserted, b.inserted, b.skipped, spark.table(f"{raw}.{name}").count())
                for name, a, b in zip(RAW_SCHEMAS, once.tables, twice.tables)
            ]
        finally:
            remove_path(spark, folder)
    columns = "name string, inserted bigint, inserted_again bigint, skipped bigint, stored bigint"
    return spark.createDataFrame(counts, columns)


def _quality_log(s: Star) -> DataFrame:
    """The log's checks, over the answers to all patients with some logged twice and some without patient."""
    logged = s.parsed().where("status = 'processed'").select("patient_id", F.lit(RUN_DATE).alias("run_date"))
    again = logged.where("patient_id like '%3'")
    lost = logged.where("patient_id like '%7'").withColumn("patient_id", F.lit(None).cast("string"))
    return check_tables({SUMMARY_TABLE: logged.unionByName(again).unionByName(lost)}, LOG_CHECKS)


def _triage_log(s: Star) -> DataFrame:
    """The log after two triage runs on one day: the second finds all of its batch done."""
    with scratch_database(s.spark, "triage") as database:
        table = f"{database}.{SUMMARY_TABLE}"
        create_table(s.spark, table, SUMMARY_SCHEMA, partition_by="run_date")
        with staged(s.high_risk(), "high-risk") as high_risk:
            reports = [triage.run_triage(high_risk, table, scorers.rule_scorer, RUN_DATE) for _ in range(2)]
        # At most one batch: the log is no longer than the batch size.
        log = s.spark.table(table).drop("created_at")
        lines = [(*row, str(reports[0]), str(reports[1])) for row in log.collect()]
    schema = T.StructType(
        [*log.schema.fields, T.StructField("first_run", T.StringType()), T.StructField("second_run", T.StringType())]
    )
    return s.spark.createDataFrame(lines, schema)


def _load_repeat_proof(s: Star) -> DataFrame:
    """Unkeyed tables loaded with `dedupe`: first every row, then again with some rows once more than before."""
    spark, counts = s.spark, []
    with scratch_database(spark, "load") as raw:
        for name in ("conditions", "observations", "medications"):
            create_table(spark, f"{raw}.{name}", RAW_SCHEMAS[name])
            # Written once: both loads, and both parts of the second, start from the same rows.
            with staged(typed_by_name(s.raw(name), RAW_SCHEMAS[name], na_tokens=()), "rows") as rows:
                more = rows.unionByName(rows.where("patient like '%7'"))
                once, twice = (load_rows(part, f"{raw}.{name}", None, dedupe=True) for part in (rows, more))
            counts.append((name, once.inserted, twice.inserted, twice.skipped, spark.table(f"{raw}.{name}").count()))
    columns = "name string, inserted bigint, inserted_again bigint, skipped bigint, stored bigint"
    return spark.createDataFrame(counts, columns)


# The last digits of the ids that a load brings: three loads of new rows, then a small one, mostly of stored ones.
LOADS = {1: "012", 2: "345", 3: "6789"}


def _load_indexed(s: Star) -> DataFrame:
    """Keyed tables in three loads, then a few stored rows and a few new ones, looked up by the key index."""
    spark, counts = s.spark, []
    with scratch_database(spark, "load") as raw:
        for name, key in PRIMARY_KEYS.items():
            create_table(spark, f"{raw}.{name}", RAW_SCHEMAS[name])
            rows = typed_by_name(s.raw(name), RAW_SCHEMAS[name], na_tokens=())
            loads = {number: rows.where(F.right(F.col(key), F.lit(1)).isin(*digits)) for number, digits in LOADS.items()}
            unknown = rows.where(f"{key} like '%88'").withColumn(key, F.concat(F.lit("new-"), key))
            loads[4] = rows.where(f"{key} like '%77'").unionByName(unknown)
            for number, part in loads.items():
                # Read from Parquet files and derived anew each time, at less than the cost of writing the rows twice.
                done = load_rows(part, f"{raw}.{name}", key, indexed=True, repeatable=True)
                stored = spark.table(f"{raw}.{name}").count()
                counts.append((name, number, done.read, done.inserted, done.skipped, stored))
    columns = "name string, load_number int, read bigint, inserted bigint, skipped bigint, stored bigint"
    return spark.createDataFrame(counts, columns)


def _triage_resumed(s: Star) -> DataFrame:
    """Answers to all flagged patients by two runs: the first is given up after three batches."""
    with scratch_database(s.spark, "triage") as database, staged(triage.prompts(s.high_risk()), "prompts") as prompts:
        table, asked = f"{database}.{ANSWER_TABLE}", triage.keyed_prompts(prompts, RUN_DATE)
        batch_rows = -(-prompts.count() // 8)
        for number, batches in (("first", 3), ("second", 8)):
            labelled = partial(scorers.labelled_scorer, number)
            for _ in islice(answer_in_batches(asked, table, labelled, batch_rows), batches):
                pass
        return kept(answered(asked, s.spark.table(table)).select("patient_id", "answer_key", "raw_response", "model_used"), "resumed")


def _high_risk_from(s: Star) -> DataFrame:
    """The high-risk list as a run builds it: patients are flagged first, and only their medications gathered."""
    flagged = kept(marts.flagged_patients(s.dim(), s.events()), "flagged")
    return marts.high_risk_from(flagged, s.raw("medications"), AS_OF)


# Tables whose failing rows are listed, with the column that names a row.
ROW_KEYS = {
    "raw_patients": "id",
    "raw_encounters": "id",
    "raw_conditions": "encounter",
    "stg_patients": "patient_id",
    "stg_encounters": "encounter_id",
    "dim_patients": "patient_id",
    "fct_clinical_events": "event_id",
    "high_risk_flag": "patient_id",
}
FAILING_EXTRA = [
    Check("raw_encounters", "patient", "unique"),
    Check("raw_conditions", "code", "not_null"),
    Check("stg_patients", "age", ">= 40"),
]


def _quality_failures(s: Star) -> DataFrame:
    """Every row that fails a check of a run, or one of a few that many rows fail."""
    return failing_rows(s.tables(), RUN_CHECKS + FAILING_EXTRA, ROW_KEYS).drop("row")


def _k_of_n(s: Star) -> DataFrame:
    # By patient, which some encounters lack.
    encounters = s.raw("encounters").select(F.col("id").alias("encounter"), "patient")
    return k_of_n_explode(encounters, "patient", list(VITALS), hashed_count(F.col("patient"), 2, len(VITALS)))


def _only(rule: Callable[[Check], bool], extra: list[Check]) -> Callable[[Star], DataFrame]:
    return lambda s: check_tables(s.tables(), [c for c in RUN_CHECKS if rule(c)] + extra)


PLANS: dict[str, Callable[[Star], DataFrame]] = {
    "stg_patients": Star.patients,
    "stg_encounters": Star.encounters,
    "encounter_stats": lambda s: marts.encounter_stats(s.encounters()),
    "dim_patients": Star.dim,
    "conditions_distinct": lambda s: marts.conditions_distinct(s.raw("conditions")),
    "observations_wide": lambda s: marts.observations_wide(s.raw("observations")),
    "first_condition": lambda s: marts.first_condition(s.raw("conditions")),
    "fct_clinical_events": Star.events,
    "active_conditions": lambda s: marts.active_conditions(s.events()),
    "latest_vitals": lambda s: marts.latest_vitals(s.events()),
    "latest_encounter": lambda s: marts.latest_encounter(s.events()),
    "current_medications": lambda s: marts.current_medications(s.raw("medications"), AS_OF),
    "risk_rules": Star.risk_flags,
    "high_risk_flag": Star.high_risk,
    "new_patients_only": _new_patients,
    "csv_roundtrip": _csv_roundtrip,
    "load_twice": _load_twice,
    "triage_candidates": lambda s: triage.candidates(s.high_risk()),
    "triage_pending": _triage_pending,
    "triage_skipped": _triage_skipped,
    "triage_prompts": lambda s: triage.prompts(s.high_risk()),
    "triage_parsed": Star.parsed,
    "triage_scored": lambda s: score_rows(triage.prompts(s.high_risk()), scorers.rule_scorer),
    "triage_day": _triage_day,
    "triage_log": _triage_log,
    "triage_report": _triage_report,
    "triage_preview": lambda s: summary_preview(s.parsed().where("status = 'processed'")),
    "quality_unique": _only(
        lambda c: c.rule == "unique",
        [Check("raw_encounters", "patient", "unique"), Check("raw_conditions", "encounter", "unique")],
    ),
    "quality_not_null": _only(
        lambda c: c.rule == "not_null",
        [Check("raw_conditions", "code", "not_null"), Check("fct_clinical_events", "bmi", "not_null")],
    ),
    "quality_expression": _only(
        lambda c: c.rule not in ("unique", "not_null"),
        [Check("stg_patients", "age", ">= 40"), Check("stg_encounters", "patient_out_of_pocket", "> 1000")],
    ),
    "quality_report": lambda s: check_tables(s.tables()),
    "quality_log": _quality_log,
    "hash_sample": lambda s: hash_sample(s.raw("encounters"), "patient", 0.6, SAMPLE_SEED).select(
        "id", "patient", "start"
    ),
    "k_of_n": _k_of_n,
    "exact_sample": lambda s: exact_sample(s.raw("encounters").select("id", "patient", "start"), "patient", 0.6, SAMPLE_SEED),
    "load_repeat_proof": _load_repeat_proof,
    "load_indexed": _load_indexed,
    "high_risk_from": _high_risk_from,
    "triage_resumed": _triage_resumed,
    "quality_failures": _quality_failures,
}


def build(name: str) -> Callable[[SparkSession, str], DataFrame]:
    plan = PLANS[name]
    return lambda spark, sf_dir: doubles(plan(Star(spark, sf_dir)))
