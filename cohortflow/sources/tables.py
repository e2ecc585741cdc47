"""Catalogue tables: creating, appending, rebuilding, reading by name."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.schemas import RAW_SCHEMAS, SUMMARY_SCHEMA

# Default name of the table of scorer answers.
ANSWER_TABLE = "triage_answers"
# Default database names and the triage log's name.
RAW_DATABASE = "raw"
MART_DATABASE = "analytics"
SUMMARY_TABLE = "triage_summaries"


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: str | None = None
) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f" partitioned by (`{partition_by}`)" if partition_by else ""
    spark.sql(f"create table if not exists {name} ({columns}) using parquet{layout}")


def create_all(
    spark: SparkSession, raw: str = RAW_DATABASE, marts: str = MART_DATABASE
) -> None:
    """Both databases, the five raw tables and the triage log."""
    for database in (raw, marts):
        spark.sql(f"create database if not exists {database}")
    for name, schema in RAW_SCHEMAS.items():
        create_table(spark, f"{raw}.{name}", schema)
    create_table(spark, f"{marts}.{SUMMARY_TABLE}", SUMMARY_SCHEMA, partition_by="run_date")


def raw_tables(spark: SparkSession, raw: str = RAW_DATABASE) -> dict[str, DataFrame]:
    """The five raw tables by name."""
    return {name: spark.table(f"{raw}.{name}") for name in RAW_SCHEMAS}


def append(df: DataFrame, table: str) -> None:
    """Append by column name. Rows become visible together when the job commits."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table)


def _versions(spark: SparkSession, name: str) -> list[str]:
    """A model's stored versions, oldest first."""
    database, _, bare = name.rpartition(".")
    pattern = re.compile(re.escape(bare) + r"__v(\d{8,})")
    tables = spark.sql(f"show tables in {database}" if database else "show tables").select("tableName").collect()
    found = [row[0] for row in tables if pattern.fullmatch(row[0])]
    prefix = f"{database}." if database else ""
    return [prefix + table for table in sorted(found, key=lambda t: int(pattern.fullmatch(t)[1]))]


def _shown(spark: SparkSession, name: str) -> str | None:
    """The version a model's view points at, None where there is no such view."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    text = spark.sql(f"describe formatted {name}").where("col_name = 'View Text'").first()["data_type"]
    return text.rpartition(" ")[2]


def rebuild(df: DataFrame, name: str) -> DataFrame:
    """Replace a model's rows and read them back.

    `name` is a view over one of the tables `<name>__v00000001`, `<name>__v00000002`, ...: the next version is
    written in full, then the view is pointed at it in one step of the catalogue, which moves no file. Whoever
    asks for the view finds the old rows or the new ones, also where columns change. A write that fails leaves the
    old rows; what a killed one wrote goes with the next rebuild. The version shown before stays until then, for
    readers that began on it. A table that bears the name itself is dropped once, right before the view is first made.
    """
    spark = df.sparkSession
    versions, shown = _versions(spark, name), _shown(spark, name)
    last = int(versions[-1].rpartition("__v")[2]) if versions else 0
    fresh = f"{name}__v{last + 1:08d}"
    create_table(spark, fresh, df.schema)
    try:
        df.write.insertInto(fresh, overwrite=True)
    except Exception:
        spark.sql(f"drop table if exists {fresh}")
        raise
    if shown is None and spark.catalog.tableExists(name):
        spark.sql(f"drop table {name}")
    spark.sql(f"create or replace view {name} as select * from {fresh}")
    for version in versions:
        if version != shown:
            spark.sql(f"drop table if exists {version}")
    return spark.table(fresh)


def publish_views(views: Mapping[str, DataFrame]) -> None:
    """Staging models are views: computed where they are used."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def append_summaries(results: DataFrame, table: str, run_date: dt.date) -> None:
    """Append triage results under their run date, stamped with the time of writing.

    A result without patient stops the write, as does a missing run date.
    """
    if run_date is None:
        raise ValueError("triage results need a run date")
    refused = F.raise_error(F.lit("triage result without patient_id")).cast("string")
    results = results.withColumn("patient_id", F.coalesce("patient_id", refused))
    stamped = results.withColumn("run_date", F.lit(run_date).cast("date")).withColumn(
        "created_at", F.current_timestamp().cast("timestamp_ntz")
    )
    append(stamped, table)


def summary_preview(summaries: DataFrame, n: int = 10) -> DataFrame:
    """A short look at the log, in a repeatable order."""
    return summaries.select("patient_id", "risk_score", "risk_label").orderBy("patient_id").limit(n)
