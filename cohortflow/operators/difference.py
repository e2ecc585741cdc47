"""Keyed difference against rows that are already stored."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row are handed out in runs of this length, so that no array grows with their number.
RUN = 10_000


def new_rows_only(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet; a NULL key never counts as stored."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")


def already_stored(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other part: incoming rows whose key is stored."""
    return incoming.join(existing.select(*keys), list(keys), "left_semi")


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row, f1 and f2. A missing value differs from every given one, wherever it stands."""
    # A hash passes over NULLs, so which columns are NULL goes in as a text of its own.
    gaps = F.concat(*[F.when(F.col(name).isNull(), "1").otherwise("0") for name in columns])
    return [F.xxhash64(F.lit(seed), gaps, *[F.col(name) for name in columns]).alias(f"f{seed}") for seed in (1, 2)]


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row `times` times over, without that column."""
    runs = F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / RUN)))
    df = df.where(F.col(times) > 0).withColumn("_run", runs)
    length = F.least(F.lit(RUN).cast("long"), F.col(times) - F.col("_run") * RUN)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), length))).drop("_run", "_copy", times)


FINGERPRINT = ["f1", "f2"]


# Bits of the map that tells which rows of a batch may be new: least and most (4 KB and 32 MB), and bits a row.
MAP_BITS, BITS_PER_ROW = (15, 28), 16


def stored_counts(incoming: DataFrame, existing: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(f1, f2, m, s): of every row of `incoming` that comes more often (m) than it is stored (s), both numbers.
    Rows are hashed where they are; one shuffle moves the fingerprints of both sides, counted before."""
    both = incoming.select(*fingerprint(columns), F.lit(True).alias("comes")).unionByName(
        existing.select(*fingerprint(columns), F.lit(False).alias("comes"))
    )
    counted = both.groupBy(*FINGERPRINT).agg(F.count_if("comes").alias("m"), F.count_if(~F.col("comes")).alias("s"))
    return counted.where("m > s")


def among(found: DataFrame, wanted: DataFrame, n: int, hashed: str = "f1") -> DataFrame:
    """The rows of `found` whose hash may be among the n of `wanted`, and few others: a bit for each of them,
    in a broadcast map of bounded size. So a join with `wanted` moves little more than the rows it keeps."""
    bits = min(max((n * BITS_PER_ROW).bit_length(), MAP_BITS[0]), MAP_BITS[1])
    place = F.shiftrightunsigned(hashed, 64 - bits) + 1
    bucket, position = F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_position")
    maps = wanted.select(bucket, position).groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_map"))
    tried = found.select("*", bucket, position).join(F.broadcast(maps), "_bucket")
    byte = F.expr("cast(conv(hex(substring(_map, cast(_position div 8 as int) + 1, 1)), 16, 10) as int)")
    is_set = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.expr("cast(_position % 8 as int)"))) != 0
    return tried.where(is_set).select(*found.columns)


def new_occurrences(incoming: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The bag difference: of a row found m times in `incoming` and s times in `stored`, m - s copies.

    `stored` is stored_counts's result, best written by then; it is counted here. Rows are equal when they agree in
    `columns`, NULLs included; equality goes by 128 bits of hash. Of rows that are stored as often as they come
    hardly any are shuffled; one that holds much of the batch is counted before any shuffle.
    """
    found = incoming.withColumns(dict(zip(FINGERPRINT, fingerprint(columns))))
    sizes = stored.agg(F.count_if(F.col("s") == 0).alias("unknown"), F.count_if(F.col("s") > 0).alias("more")).first()
    parts = []
    if sizes.unknown:
        unknown = stored.where("s = 0").select(*FINGERPRINT)
        parts.append(among(found, unknown, sizes.unknown).join(unknown, FINGERPRINT, "left_semi").drop(*FINGERPRINT))
    if sizes.more:
        # Rows stored fewer times than they come now need some of their copies, all of which are the same.
        more = stored.where("s > 0")
        batch = among(found, more, sizes.more).groupBy(*FINGERPRINT).agg(F.first(F.struct(*incoming.columns)).alias("row"))
        more = batch.join(more, FINGERPRINT).select("row.*", (F.col("m") - F.col("s")).alias("_times"))
        parts.append(repeated(more, "_times"))
    return reduce(DataFrame.unionByName, parts) if parts else incoming.limit(0)
