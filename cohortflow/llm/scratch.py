"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession

from cohortflow.session import remove_path, scratch_path


def new_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application's Python ends."""
    path = scratch_path(spark, label)

    def clear() -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            remove_path(spark, path)

    atexit.register(clear)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written once as Parquet and read back: later jobs start from the files.

    Lost executors cost only the tasks they were running, never the work before the write.
    """
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
