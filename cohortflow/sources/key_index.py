"""Which files of a table may hold a key: key ranges and Bloom bits per file, kept in two tables beside it.

`<table>__key_files` has a row per file: its name, length, time of change, keys, lowest and highest key, and the
number of its slots. `<table>__key_bits` has a row per file and slot: eight longs, in each of which a key sets one
bit. With 16 keys a slot that is 4 bytes a key, and a file without a key is taken for one that may hold it with a
chance of about 1 in 50,000.

Entries count only for a file that still has the length and the time of change they name. Files without such an
entry, written by other means or changed since, are always read. So a missing, old or half-written index costs time
but never changes a result. Bits are written before the file rows that make them count.
"""

from __future__ import annotations

from contextlib import nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.session import hadoop_path, staged
from cohortflow.sources.tables import append, create_table

KEYS_PER_SLOT = 16
LANES = [f"lane{i}" for i in range(8)]
# Seeds of the two hashes: which slot a key goes to, which bits it sets there.
SLOT_SEED, BIT_SEED = 11, 12

FILES_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("bytes", "modified", "n", "slots")]
    + [T.StructField(name, T.StringType()) for name in ("low", "high")]
)
BITS_SCHEMA = T.StructType(
    [T.StructField("file", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("slots", "slot", *LANES)]
)


def _slot() -> Column:
    return F.pmod(F.xxhash64(F.lit(SLOT_SEED), "key"), F.col("slots")).alias("slot")


def _bits() -> list[Column]:
    """Per lane, one of 64 bits, chosen by six bits of the key's hash."""
    hashed = F.xxhash64(F.lit(BIT_SEED), "key")
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(len(LANES))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def _names(table: str) -> tuple[str, str]:
    return f"{table}__key_files", f"{table}__key_bits"


def _location(spark: SparkSession, table: str) -> str:
    # Picked here: a command's rows are on the driver, and any operator over them would start jobs.
    found = spark.sql(f"describe formatted {table}").collect()
    return next(row["data_type"] for row in found if row["col_name"] == "Location")


def _listing(spark: SparkSession, table: str) -> dict[str, tuple[str, int, int]]:
    """The table's data files by name: path, length and time of change in milliseconds."""
    fs, folder = hadoop_path(spark, _location(spark, table))
    found = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            found[name] = (status.getPath().toString(), status.getLen(), status.getModificationTime())
    return found


def _entries(spark: SparkSession, table: str) -> list[Row]:
    """The index's entries. There are as many as files, which the driver lists anyway."""
    files, bits = _names(table)
    if not (spark.catalog.tableExists(files) and spark.catalog.tableExists(bits)):
        return []
    return spark.table(files).select("file", "bytes", "modified", "n", "slots").collect()


def _valid(entries: list[Row], listing: dict[str, tuple[str, int, int]]) -> set[str]:
    """Names of files whose entry still holds."""
    return {e["file"] for e in entries if listing.get(e["file"], ())[1:] == (e["bytes"], e["modified"])}


def _key_text(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if not isinstance(kind, (T.StringType, T.IntegralType)):
        raise ValueError(f"keys of type {kind.simpleString()} cannot be indexed: equal ones may print differently")
    return F.col(key).cast("string").alias("key")


def index_new_files(spark: SparkSession, table: str, key: str) -> int:
    """Enter every file that has no valid entry yet; the number of them. Reads their key column twice.

    The table must not be partitioned. A file with NULL keys only gets no entry.
    """
    listing = _listing(spark, table)
    new = sorted(set(listing) - _valid(_entries(spark, table), listing))
    if not new:
        return 0
    for name, schema in zip(_names(table), (FILES_SCHEMA, BITS_SCHEMA)):
        create_table(spark, name, schema)
    stored = spark.read.schema(spark.table(table).schema).parquet(*[listing[name][0] for name in new])
    file = [
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
    ]
    rows = stored.where(F.col(key).isNotNull()).select(*file, _key_text(stored, key))
    per_file = rows.groupBy("file", "bytes", "modified").agg(
        F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    # The least power of two that leaves at most KEYS_PER_SLOT keys a slot on average.
    steps = F.greatest(F.ceil(F.log2(F.col("n") / KEYS_PER_SLOT)), F.lit(0)).cast("int")
    slots = F.call_function("shiftleft", F.lit(1).cast("long"), steps)
    with staged(per_file.withColumn("slots", slots), "key-files") as counted:
        marks = rows.select("file", "key").join(counted.select("file", "slots"), "file").groupBy("file", "slots", _slot())
        append(marks.agg(*[F.bit_or(bit).alias(lane) for lane, bit in zip(LANES, _bits())]), _names(table)[1])
        append(counted, _names(table)[0])
    return len(new)


def may_hold(batch: DataFrame, table: str, key: str, n_keys: int | None = None) -> DataFrame:
    """The table without those files that hold none of the batch's keys, by their ranges and bits.

    Every key of the batch is tried on one slot of every indexed file. Where that comes to more tries than the
    table has keys, scanning the keys is cheaper and the whole table is returned. `n_keys` promises that the batch
    is written and gives each of its keys once, NULL aside, and is their number.
    """
    spark = batch.sparkSession
    whole, listing = spark.table(table), _listing(spark, table)
    entries = _entries(spark, table)
    valid = _valid(entries, listing)
    if not valid:
        return whole
    keys = batch.where(F.col(key).isNotNull()).select(_key_text(batch, key))
    with nullcontext(keys) if n_keys is not None else staged(keys.distinct(), "batch-keys") as keys:
        tries = (keys.count() if n_keys is None else n_keys) * len(valid)
        if tries > sum(e["n"] for e in entries):
            return whole
        wanted = (set(listing) - valid) | (_holding(keys, table, {e["slots"] for e in entries}) & set(listing))
    if not wanted:
        return whole.limit(0)
    return spark.read.schema(whole.schema).parquet(*[listing[name][0] for name in sorted(wanted)])


def _holding(keys: DataFrame, table: str, sizes: set[int]) -> set[str]:
    """Names of indexed files that may hold one of the keys. `sizes` are at most one for every power of two."""
    files, bits = (keys.sparkSession.table(name) for name in _names(table))
    tries = keys.withColumn("slots", F.explode(F.array(*[F.lit(size).cast("long") for size in sorted(sizes)])))
    tries = tries.select("key", "slots", _slot(), *[bit.alias(f"_{lane}") for lane, bit in zip(LANES, _bits())])
    agree = reduce(Column.__and__, [F.col(lane).bitwiseAND(F.col(f"_{lane}")) == F.col(f"_{lane}") for lane in LANES])
    found = bits.join(tries, ["slots", "slot"]).where(agree).select("file", "key").join(files, "file")
    hits = found.where(F.col("key").between(F.col("low"), F.col("high"))).select("file").distinct().collect()
    return {row["file"] for row in hits}
