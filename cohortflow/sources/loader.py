"""Loading CSV files into the raw tables.

One writer at a time: two loads running together could both find a key missing.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators.difference import already_stored, new_occurrences, new_rows_only, stored_counts
from cohortflow.schemas import PRIMARY_KEYS, RAW_SCHEMAS
from cohortflow.session import hadoop_path, staged
from cohortflow.sources.csv_files import read_csv, typed_by_name
from cohortflow.sources.key_index import index_new_files, may_hold
from cohortflow.sources.tables import RAW_DATABASE, append

log = logging.getLogger(__name__)


class KeyViolation(ValueError):
    """A batch holds a NULL key, or the same new key twice."""


@dataclass(frozen=True)
class TableLoad:
    table: str
    read: int
    skipped: int
    inserted: int


@dataclass
class LoadReport:
    tables: list[TableLoad] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)

    @property
    def total(self) -> int:
        """Rows inserted over all tables."""
        return sum(t.inserted for t in self.tables)


def load_rows(
    rows: DataFrame, table: str, key: str | None, dedupe: bool = False, indexed: bool = False, repeatable: bool = False
) -> TableLoad:
    """Append typed rows to a table; with a key, only those whose key is new.

    Without a key all rows are appended, or with `dedupe` only the copies of a row that go beyond those stored.
    With `indexed`, stored keys are looked up only in files that may hold one of the batch's (see key_index),
    and the files written are entered in that index. It pays where batches are small beside the table.
    `repeatable` promises that `rows` are the same whenever they are read, and cheap to read: with a key, only the
    keys are then written before the append, and a value that does not fit stops the append, which adds all or nothing.
    """
    if key is None and (not dedupe or rows.sparkSession.table(table).isEmpty()):
        return _append_all(rows, table)
    if key is None:
        seen = Observation()
        with staged(rows.observe(seen, F.count(F.lit(1)).alias("n")), "load") as batch:
            return _append_unseen(batch, table, seen.get.get("n", 0))
    if repeatable:
        return _append_new(rows, table, key, indexed)
    with staged(rows, "load") as batch:
        return _append_new(batch, table, key, indexed)


def _append_all(rows: DataFrame, table: str) -> TableLoad:
    # The write has no shuffle, so each row is counted by exactly one finished task.
    seen = Observation()
    append(rows.observe(seen, F.count(F.lit(1)).alias("n")), table)
    count = seen.get.get("n", 0)  # no rows, nothing observed
    return TableLoad(table, count, 0, count)


def _append_unseen(batch: DataFrame, table: str, read: int) -> TableLoad:
    if not read:
        return TableLoad(table, 0, 0, 0)
    # The time of loading is not part of what a row says.
    columns = [name for name in batch.columns if name != "loaded_at"]
    existing = batch.sparkSession.table(table)
    # Counted and written before the append, which changes what is stored.
    with staged(stored_counts(batch, existing, columns), "stored-rows") as stored:
        # When every row is new there is nothing to filter out.
        if stored.agg(F.sum(F.when(F.col("s") == 0, F.col("m")))).first()[0] == read:
            return _append_all(batch, table)
        with staged(new_occurrences(batch, stored, columns), "new-rows") as rows:
            added = _append_all(rows, table).inserted
    return TableLoad(table, read, read - added, added)


def _new_rows(key: str) -> list[Column]:
    """Of keys with their numbers of rows: all rows, those without key, and keys given twice."""
    n = F.col("n")
    return [
        F.coalesce(F.sum(n), F.lit(0)).alias("new"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), n)), F.lit(0)).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (n > 1)).alias("repeated"),
    ]


def _append_new(batch: DataFrame, table: str, key: str, indexed: bool) -> TableLoad:
    # Keys only, counted once: all checks start from these, the batch's other columns are read for the append alone,
    # and a key that fills much of the file is one row by then.
    seen, met = Observation(), Observation()
    per_key = batch.groupBy(key).agg(F.count("*").alias("n"))
    with staged(per_key.observe(seen, F.count(key).alias("keys"), *_new_rows(key)), "keys") as keys:
        read = seen.get.get("new", 0)  # no rows, nothing observed
        if not read:
            return TableLoad(table, 0, 0, 0)
        existing = may_hold(keys, table, key, seen.get["keys"]) if indexed else batch.sparkSession.table(table)
        # The batch's stored keys, found once. The batch is the small side of this join, which
        # Spark broadcasts by its size, so that stored keys are scanned but neither moved nor sorted.
        stored = already_stored(existing.select(key), keys, [key])
        with staged(stored.observe(met, F.count(F.lit(1)).alias("n")), "hits") as hits:
            # When no key is stored, all of the batch is new, and its figures are known.
            found = new_rows_only(keys, hits, [key]).agg(*_new_rows(key)).first() if met.get.get("n", 0) else seen.get
            if found["null_keys"] or found["repeated"]:
                raise KeyViolation(
                    f"{table}.{key}: {found['null_keys']} rows without key, {found['repeated']} keys given twice"
                )
            if found["new"]:
                # When every key is new there is nothing to filter out.
                append(batch if found["new"] == read else new_rows_only(batch, hits, [key]), table)
    if indexed:
        # Also enters files of loads that stopped before this line.
        index_new_files(batch.sparkSession, table, key)
    return TableLoad(table, read, read - found["new"], found["new"])


def load_file(
    spark: SparkSession,
    path: str,
    name: str,
    database: str = RAW_DATABASE,
    na_tokens: Sequence[str] = ("",),
    multiline: bool | None = None,
    dedupe: bool = False,
    indexed: bool = False,
) -> TableLoad:
    """Load one CSV source into raw table `name`. `dedupe` and `indexed` are load_rows's."""
    text = read_csv(spark, path, multiline)
    key = PRIMARY_KEYS.get(name)
    if key is not None and key not in text.columns:
        raise ValueError(f"{path}: key column {key} is missing")
    result = load_rows(typed_by_name(text, RAW_SCHEMAS[name], na_tokens), f"{database}.{name}", key, dedupe, indexed)
    log.info("%s: read %d, skipped %d, inserted %d", result.table, result.read, result.skipped, result.inserted)
    return result


def load_folder(
    spark: SparkSession,
    folder: str,
    database: str = RAW_DATABASE,
    na_tokens: Sequence[str] = ("",),
    multiline: bool | None = None,
    dedupe: bool = False,
    indexed: bool = False,
) -> LoadReport:
    """Load <table>.csv for every raw table; a file that is not there is reported, not fatal.

    Tables are committed one by one, so an error leaves earlier tables loaded. With `dedupe`, loading a file
    again adds nothing to tables without key either, while rows repeated inside a file stay. `indexed` is
    load_rows's, for the tables with a key.
    """
    report = LoadReport()
    for name in RAW_SCHEMAS:
        path = f"{folder.rstrip('/')}/{name}.csv"
        fs, target = hadoop_path(spark, path)
        if not fs.exists(target):
            log.warning("file not found, skipping: %s", path)
            report.missing.append(f"{name}.csv")
            continue
        report.tables.append(load_file(spark, path, name, database, na_tokens, multiline, dedupe, indexed))
    log.info("load complete, %d rows inserted", report.total)
    return report
