import os

import pytest

from cohortflow.session import require_ansi, scratch_database, scratch_path, shared_folder, staged


def local(path):
    return path.removeprefix("file:")


def test_the_session_names_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named if named else folder.startswith("file:")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(folder)


def test_staged_rows_are_computed_once_and_removed(spark):
    runs = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    with staged(spark.range(10).mapInPandas(touch, "id bigint"), "test") as rows:
        path = local(os.path.dirname(rows.inputFiles()[0]))
        assert rows.count() == 10 and rows.where("id > 4").count() == 5
        assert os.path.isdir(path)
    assert runs.value == 10 and not os.path.exists(path)


def test_staged_is_removed_after_an_error(spark):
    with pytest.raises(KeyError), staged(spark.range(1), "test") as rows:
        path = local(os.path.dirname(rows.inputFiles()[0]))
        raise KeyError
    assert not os.path.exists(path)


def test_scratch_database_is_dropped(spark):
    with scratch_database(spark, "tmpdb") as name:
        spark.range(3).write.saveAsTable(f"{name}.t")
        assert spark.table(f"{name}.t").count() == 3
    assert not spark.catalog.databaseExists(name)


def test_ansi_is_required(spark):
    require_ansi(spark)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            require_ansi(spark)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
