"""A store of scorer answers that survives a killed run.

Answers are appended batch by batch under a key made of what was asked. A run that stops after some batches
leaves them in the store; the next run asks only what has no usable answer there.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.operators.difference import new_rows_only
from cohortflow.operators.scoring import ScorerFactory, score_rows
from cohortflow.operators.selection import first_per_key
from cohortflow.schemas import RESPONSE_SCHEMA
from cohortflow.session import staged
from cohortflow.sources.tables import append, create_table

log = logging.getLogger(__name__)

ANSWER_SCHEMA = T.StructType([T.StructField("answer_key", T.StringType()), *RESPONSE_SCHEMA.fields, T.StructField("run_date", T.DateType())])


def answer_key(*asked: Column) -> Column:
    """SHA-256 over what was asked. Every part is preceded by its length, so that parts cannot run into each other."""
    texts = [part.cast("string") for part in asked]
    framed = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def missing_answers(asked: DataFrame, store: DataFrame) -> DataFrame:
    """The rows (answer_key, prompt, ...) that the store has no usable answer for."""
    return new_rows_only(asked, store.where("scorer_error is null"), ["answer_key"])


def answer_in_batches(
    asked: DataFrame, table: str, factory: ScorerFactory, batch_rows: int = 1000, partitions: int | None = None
) -> Iterator[int]:
    """Score what `asked` (answer_key, prompt, run_date) still lacks, and commit about `batch_rows` rows at a time.

    Yields the number of rows of every batch once it is in `table`. A key that is asked twice is scored once.
    Which batch a key is in depends on the key and the number of batches alone, and every batch is scored by
    tasks; a batch with an error in it is stored with the error, and asked again by the next run.
    """
    spark = asked.sparkSession
    create_table(spark, table, ANSWER_SCHEMA, partition_by="run_date")
    rest = first_per_key(missing_answers(asked, spark.table(table)), ["answer_key"], ["run_date"])
    with staged(rest.select("answer_key", "prompt", "run_date"), "asked") as todo:
        total = todo.count()
        batches = -(-total // batch_rows)
        number = F.conv(F.substring("answer_key", 1, 8), 16, 10).cast("long") % max(batches, 1)
        for k in range(batches):
            # One job scores and commits a batch. The rows counted are those of its finished tasks.
            seen = Observation()
            scored = score_rows(todo.where(number == k), factory, partitions=partitions)
            append(scored.observe(seen, F.count(F.lit(1)).alias("n")), table)
            log.info("batch %d of %d is stored", k + 1, batches)
            yield seen.get.get("n", 0)


def answered(asked: DataFrame, store: DataFrame) -> DataFrame:
    """`asked` with the response columns: a usable answer where the store has one, else an error it has."""
    columns = [f.name for f in RESPONSE_SCHEMA.fields]
    rank = F.col("scorer_error").isNotNull()
    best = first_per_key(store.select("answer_key", rank.alias("failed"), *columns), ["answer_key"], ["failed", "raw_response"])
    return asked.join(best.drop("failed"), "answer_key", "left")
