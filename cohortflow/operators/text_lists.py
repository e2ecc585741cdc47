"""Ordered text aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    text: Column,
    newest_first: Column,
    where: Column,
    name: str,
    sep: str = "; ",
    every_key: bool = True,
) -> DataFrame:
    """Per key, the texts of the rows passing `where`, repeats kept, newest first.

    Rows without a date come first, equal dates go by text, NULL texts are left
    out. A key with nothing left keeps its row with NULL, or, without `every_key`,
    has none: other rows are then dropped at the scan.

    Equal (key, date, text) rows are counted first. That step has fixed-size
    buffers and spreads a hot key over all tasks, so the step that builds a key's
    text gets each distinct pair once, and all dropped rows of a key as one.
    """
    keep = F.coalesce(where, F.lit(False)) & text.isNotNull()
    runs = (
        (df if every_key else df.where(where & text.isNotNull())).select(
            *keys,
            F.when(keep, newest_first).alias("_when"),
            F.when(keep, text).alias("_text"),
        )
        .groupBy(*keys, "_when", "_text")
        .agg(F.count("*").alias("_n"))
    )
    repeated = F.concat(
        F.col("_text"), F.repeat(F.concat(F.lit(sep), F.col("_text")), (F.col("_n") - 1).cast("int"))
    )
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    return (
        runs.withColumn("_run", F.when(F.col("_text").isNotNull(), repeated))
        .groupBy(*keys)
        .agg(
            F.expr(
                f"listagg(_run, '{quoted}') within group (order by _when desc nulls first, _text)"
            ).alias(name)
        )
    )
