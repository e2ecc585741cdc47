"""Session helpers: a local session for tests, and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "cohortflow", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        # Plans here are built from many small expressions; recording a call site for each is slow.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_ansi(spark: SparkSession) -> None:
    """Bad text must abort a load; without ANSI mode a cast would turn it into NULL."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise RuntimeError("cohortflow needs spark.sql.ansi.enabled=true")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortflow-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/cohortflow/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for any URI Spark itself can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this application made."""
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


@contextmanager
def scratch_database(spark: SparkSession, label: str) -> Iterator[str]:
    """A database in the shared folder that is dropped, tables and all, when the block ends."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, label)
    spark.sql(f"create database {name} location '{path}'")
    try:
        yield name
    finally:
        spark.sql(f"drop database {name} cascade")
        remove_path(spark, path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write df once and hand back the written copy, dropped when the block ends.

    Used where a result is needed by several jobs and must not be computed again,
    even if the executors that computed it are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write df once and hand back the written copy, which stays until the application's Python ends.

    For results that are lazy themselves and need df whenever they are read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)

    def clear() -> None:
        with suppress(Exception):  # the session may be gone already
            remove_path(spark, path)

    atexit.register(clear)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
