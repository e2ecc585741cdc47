"""Loads that open only files which may hold the batch's keys."""

import os
import shutil

import pytest
from conftest import rows

from pyspark.sql import functions as F

from cohortflow.schemas import RAW_SCHEMAS
from cohortflow.session import staged
from cohortflow.sources import key_index
from cohortflow.sources.key_index import index_new_files, may_hold
from cohortflow.sources.loader import KeyViolation, load_folder, load_rows

TABLE = "raw.patients"


def patients(spark, start, stop, files=1):
    """Rows whose ids are hashes, so that every file's range holds nearly every id."""
    ids = spark.range(start, stop, 1, files).select(F.md5(F.col("id").cast("string")).alias("id"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS["patients"] if f.name != "id"]
    return ids.select("id", *empty).select(*RAW_SCHEMAS["patients"].names)


def stored_files(spark):
    return {os.path.basename(name) for name in spark.table(TABLE).inputFiles()}


def opened(spark, batch):
    with staged(batch, "batch") as batch:
        return {os.path.basename(name) for name in may_hold(batch, TABLE, "id").inputFiles()}


@pytest.fixture()
def loaded(spark, databases):
    """Six files of 500 keys."""
    patients(spark, 0, 3000, 6).write.insertInto(TABLE)
    assert index_new_files(spark, TABLE, "id") == len(stored_files(spark)) == 6


def test_only_files_that_may_hold_a_key_are_opened(spark, loaded):
    holds = {os.path.basename(r[0]) for r in spark.table(TABLE).where(F.col("id") == F.md5(F.lit("1700"))).select(F.input_file_name()).collect()}
    assert len(holds) == 1 and opened(spark, patients(spark, 1700, 1701)) == holds
    assert opened(spark, patients(spark, 5000, 5100)) == set()
    # More tries than there are keys: the table is scanned as it is.
    assert opened(spark, patients(spark, 5000, 6000)) == stored_files(spark)


@pytest.mark.parametrize("start, stop", [(2990, 3010), (2500, 9000)])
def test_results_equal_those_of_a_plain_load(spark, loaded, start, stop):
    batch = patients(spark, start, stop, 3)
    batch = batch.unionByName(batch.where(F.col("id") == F.md5(F.lit("2995"))))  # a stored id may come twice
    before = spark.table(TABLE).select("id")
    want = batch.join(before, "id", "left_anti").count()
    result = load_rows(batch, TABLE, "id", indexed=True)
    assert (result.read, result.inserted) == (batch.count(), want)
    ids = spark.table(TABLE).groupBy("id").count()
    assert ids.where("count > 1").count() == 0 and ids.count() == 3000 + want


def test_bad_keys_still_stop(spark, loaded):
    for bad in (patients(spark, 7000, 7001).unionByName(patients(spark, 7000, 7001)),
                patients(spark, 7000, 7001).withColumn("id", F.lit(None).cast("string"))):
        with pytest.raises(KeyViolation):
            load_rows(bad, TABLE, "id", indexed=True)
    assert spark.table(TABLE).count() == 3000


def test_files_written_by_other_means_are_read_until_indexed(spark, loaded):
    before = stored_files(spark)
    patients(spark, 4000, 4010).write.insertInto(TABLE)
    extra = stored_files(spark) - before
    assert opened(spark, patients(spark, 8000, 8001)) == extra
    assert load_rows(patients(spark, 4000, 4010), TABLE, "id", indexed=True).inserted == 0
    assert opened(spark, patients(spark, 8000, 8001)) == set()
    assert index_new_files(spark, TABLE, "id") == 0


def test_a_changed_file_outdates_its_entry(spark, loaded, tmp_path):
    """One file is replaced by another of the same name: its old entry says nothing about it."""
    folder = key_index._location(spark, TABLE).removeprefix("file:")
    name = sorted(stored_files(spark))[0]
    patients(spark, 6000, 6010).write.parquet(f"{tmp_path}/other")
    part = next(f for f in os.listdir(f"{tmp_path}/other") if f.startswith("part-"))
    shutil.copyfile(f"{tmp_path}/other/{part}", f"{folder}/{name}")
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    spark.catalog.refreshTable(TABLE)
    assert opened(spark, patients(spark, 9000, 9001)) == {name}
    assert load_rows(patients(spark, 6000, 6012), TABLE, "id", indexed=True).inserted == 2


def test_a_lost_or_half_written_index_changes_nothing(spark, loaded):
    # Bits without the file rows that make them count: a load that stopped between the two writes.
    spark.sql(f"truncate table {TABLE}__key_files")
    assert opened(spark, patients(spark, 8000, 8001)) == stored_files(spark)
    assert load_rows(patients(spark, 10, 20), TABLE, "id", indexed=True).inserted == 0
    assert opened(spark, patients(spark, 8000, 8001)) == set()
    assert len(opened(spark, patients(spark, 10, 11))) == 1
    # Rows naming files that are gone.
    spark.sql(f"truncate table {TABLE}")
    assert load_rows(patients(spark, 0, 10), TABLE, "id", indexed=True).inserted == 10


def test_empty_tables_odd_keys_and_types(spark, databases):
    assert load_rows(patients(spark, 0, 0), TABLE, "id", indexed=True).inserted == 0
    assert index_new_files(spark, TABLE, "id") == 0
    odd = ["", " ", "é" * 400, "a\nb", "Ω"]
    batch = patients(spark, 0, 1).withColumn("id", F.explode(F.array(*[F.lit(key) for key in odd])))
    assert load_rows(batch, TABLE, "id", indexed=True).inserted == 5
    for key in odd:
        assert len(opened(spark, patients(spark, 0, 1).withColumn("id", F.lit(key)))) >= 1
    with pytest.raises(ValueError, match="print differently"):
        may_hold(batch.selectExpr("cast(1.5 as double) as id"), TABLE, "id")


def test_folder_load_with_an_index(spark, databases, tmp_path):
    (tmp_path / "patients.csv").write_text("Id\np1\np2\n")
    (tmp_path / "conditions.csv").write_text("CODE\n1\n")
    assert load_folder(spark, str(tmp_path), indexed=True).total == 3
    again = {t.table: t.inserted for t in load_folder(spark, str(tmp_path), indexed=True).tables}
    assert again == {TABLE: 0, "raw.conditions": 1}
    assert rows(spark.table(TABLE), "id") == [("p1",), ("p2",)]


def jobs_of(spark, action):
    """Numbers of Spark jobs that an action starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_looking_a_table_up_starts_no_jobs_of_its_own(spark, loaded):
    assert jobs_of(spark, lambda: key_index._listing(spark, TABLE)) == 0
    with staged(patients(spark, 5000, 9000), "batch") as batch:
        # One job reads the index's entries; a batch that is too large for the index needs no other.
        assert jobs_of(spark, lambda: may_hold(batch, TABLE, "id", 4000)) <= 1


@pytest.mark.parametrize("start, stop", [(3000, 3500), (2990, 3010), (0, 10), (5000, 5000)])
def test_repeatable_rows_load_like_others(spark, loaded, start, stop):
    batch = patients(spark, start, stop, 3)
    want = max(0, stop - max(start, 3000))
    result = load_rows(batch, TABLE, "id", indexed=True, repeatable=True)
    assert (result.read, result.inserted, result.skipped) == (stop - start, want, stop - start - want)
    assert spark.table(TABLE).count() == spark.table(TABLE).select("id").distinct().count() == 3000 + want
    assert load_rows(batch, TABLE, "id", indexed=True, repeatable=True).inserted == 0


def test_repeatable_rows_are_not_written_on_the_way(spark, databases, monkeypatch):
    from cohortflow.sources import loader

    written = []
    monkeypatch.setattr(loader, "staged", lambda df, label: written.append((label, df.columns)) or staged(df, label))
    batch = patients(spark, 0, 20)
    assert load_rows(batch, TABLE, "id", repeatable=True).inserted == 20
    assert written == [("keys", ["id", "n"]), ("hits", ["id"])]
    for bad in (batch.unionByName(batch), batch.withColumn("id", F.lit(None).cast("string"))):
        with pytest.raises(KeyViolation):
            load_rows(bad.withColumn("id", F.concat(F.lit("x"), "id")), TABLE, "id", repeatable=True)
    assert spark.table(TABLE).count() == 20
