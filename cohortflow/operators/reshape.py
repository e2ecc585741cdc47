"""Long-to-wide and row-multiplying operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.aggregates import measure_columns


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    mapping: Mapping[str, str],
    dtype: str,
    code: str = "code",
    value: str = "value",
) -> DataFrame:
    """One row per key, one column per mapped code, holding the largest value.

    The code list is given, so no job is needed to discover it, and the buffers
    are fixed-width numbers: rows are combined by hash before the shuffle.
    """
    return df.groupBy(*keys).agg(*measure_columns(F.col(code), F.col(value), mapping, dtype))


def k_of_n_explode(
    df: DataFrame, key: str, catalogue: Sequence[str], k: Column, name: str = "code"
) -> DataFrame:
    """Each row becomes k rows, one per catalogue entry picked by a hash of entry and key.

    A missing key counts as the empty text.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    entries = [
        F.struct(F.md5(F.concat(F.lit(entry), text)).alias("h"), F.lit(entry).alias("entry"))
        for entry in catalogue
    ]
    picked = F.slice(F.sort_array(F.array(*entries)), 1, k)
    return df.withColumn("_pick", F.explode(picked)).withColumn(name, F.col("_pick.entry")).drop("_pick")


def hashed_count(key: Column, low: int, high: int) -> Column:
    """A whole number in [low, high], fixed by a hash of key; a missing key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    word = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (F.lit(low) + F.pmod(word, F.lit(high - low + 1))).cast("int")
