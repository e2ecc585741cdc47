"""Choosing rows: first and latest per key, top rows, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.difference import repeated

# Hex digits by which a search for a rank narrows down in one pass, and ranks that are fetched at once.
STEP_DIGITS = 3
FEW = 10_000


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order`, ascending, NULLs last.

    Rows equal in all of `order` go by the remaining columns, so the choice never
    depends on row placement. Written as a minimum over whole rows: a task passes
    on one row per key, so a hot key costs no more than others, nothing but the
    key is sorted on, and the optimizer knows that the result is unique per key.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    rank = [
        part for name in order for part in (F.col(name).isNull().alias(f"_{name}_is_null"), F.col(name))
    ]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rank, *rest)).alias("_first"))
    return first.select(*[name if name in keys else f"_first.{name}" for name in df.columns])


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows by `order`; planned as a per-task top-n and one small merge."""
    return df.orderBy(*order).limit(n)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: str | int = 0) -> DataFrame:
    """Keep about `fraction` of the rows, chosen by a hash of seed and key.

    A plain row filter: no shuffle, and the same rows on every run and retry. Rows
    without key share the hash of the empty text.
    """
    if fraction >= 1:
        return df
    if fraction <= 0:
        return df.where(F.lit(False))
    bound = format(int(fraction * 2**32), "08x")
    digest = F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return df.where(F.substring(digest, 1, 8) < bound)


def exact_sample(df: DataFrame, key: str, fraction: float, seed: str | int = 0) -> DataFrame:
    """Exactly round(fraction * rows) rows: those with the smallest hashes of seed and key.

    Rows of one key go by a hash of the whole row. The smallest hash left out is found without sorting: a pass
    counts rows by the next digits of their hash, 4,096 counts at most, and the one that holds the wanted rank
    is looked into by the next pass, until few hashes are left. Two or three passes do, a few more where one
    key holds most rows. Columns but the key are read only to part rows of equal key. Rows without key share the
    hash of the empty text. The same rows are chosen on every run.
    """
    wanted = round(fraction * df.count())
    if wanted <= 0:
        return df.where(F.lit(False))
    by_key = F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    by_row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in df.columns]))
    low, before, width = "", 0, 64  # all hashes that start with `low` have ranks after `before`
    while True:
        digest = by_key if len(low) + STEP_DIGITS <= 32 else F.concat(by_key, by_row)
        inside = df.select(digest.alias("h")).where(F.col("h").startswith(low))
        counts = inside.groupBy(F.substring("h", len(low) + 1, STEP_DIGITS).alias("d")).count().orderBy("d").collect()
        for row in counts:
            if before + row["count"] >= wanted:
                break
            before += row["count"]
        low, held = low + row["d"], row["count"]
        if held <= FEW or len(low) >= width:
            break
    digest = F.concat(by_key, by_row)
    # No more than FEW rows, or one row's copies: then they share one hash.
    last = df.select(digest.alias("h")).where(F.col("h").startswith(low)).groupBy("h").count().orderBy("h").collect()
    for row in last:
        if before + row["count"] >= wanted:
            break
        before += row["count"]
    if before + row["count"] == wanted:
        return df.where(digest <= row["h"])
    # Copies of one row: any of them are the same.
    rest = df.where(digest == row["h"]).limit(1).withColumn("_times", F.lit(wanted - before).cast("long"))
    return df.where(digest < row["h"]).unionByName(repeated(rest, "_times"))
