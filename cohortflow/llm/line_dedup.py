"""Line dedup against levelled sorted runs of line hashes, all built in.

Batches of documents come one after another. The hashes of a batch's lines are merge-anti-joined with the runs
stored so far; those found nowhere become a sorted run of their own. Runs are bucketed, sorted tables, so a
merge moves none of them. As soon as a level holds `fanout` runs they are compacted to one run of the next.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.llm.scratch import new_folder, written

# What is stripped from both ends of a line, and the letters that are lower-cased.
ENDS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HASH = ["h1", "h2"]
ROW = ["doc_id", "text_hash"]


def line_key(line: Column) -> Column:
    """The form in which lines are compared: ends stripped, A-Z in lower case."""
    bare = F.btrim(line, F.lit(ENDS))
    # Only a line with other than ASCII letters needs the slower way, which leaves those alone.
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_hash() -> Column:
    # With the id it names a row; rows that agree in both share their result.
    return F.xxhash64(F.lit(1), F.coalesce("text", F.lit("")))


def hashed_lines(docs: DataFrame, least_chars: int = 10) -> DataFrame:
    """(doc_id, text_hash, place, h1, h2): every line long enough, by 128 bits of hash of its key."""
    lines = docs.select("doc_id", _text_hash().alias("text_hash"), F.posexplode(_lines_of(F.col("text"))).alias("place", "line"))
    keyed = lines.select(*ROW, "place", line_key(F.col("line")).alias("key"))
    # A constant before the key seeds the hash: the two halves are independent.
    halves = [F.xxhash64(F.lit(seed), "key").alias(name) for seed, name in enumerate(HASH)]
    return keyed.where(F.char_length("key") >= least_chars).select(*ROW, "place", *halves)


class LineRuns:
    """The lines seen so far, as levels of sorted runs in a database of their own in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.database = f"line_runs_{uuid.uuid4().hex[:12]}"
        spark.sql(f"create database {self.database} location '{new_folder(spark, 'line-runs')}'")
        atexit.register(self.close)

    def close(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone already
            self.spark.sql(f"drop database if exists {self.database} cascade")

    def _sorted(self, hashes: DataFrame, label: str) -> str:
        """A table dealt and sorted by hash. Readers that join by hash neither move nor gather its rows."""
        name = f"{self.database}.{label}_{uuid.uuid4().hex[:12]}"
        hashes.write.format("parquet").bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def _compact(self) -> None:
        """Every full level becomes one run of the next. No hash is in two runs, so rows are only put together."""
        for level, runs in enumerate(self.levels):
            if len(runs) < self.fanout:
                continue
            whole = reduce(DataFrame.unionByName, [self.spark.table(run).select(*HASH) for run in runs])
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._sorted(whole.repartition(self.buckets, *HASH), f"run{level + 1}"))
            for run in runs:
                self.spark.sql(f"drop table {run}")
            self.levels[level] = []

    def add(self, lines: DataFrame) -> DataFrame:
        """(doc_id, text_hash, place) of the lines to drop from this batch (see hashed_lines): those stored by an
        earlier batch, and those that a smaller doc_id of the batch holds. The rest is stored as a run.
        """
        self._compact()
        doc = F.col("doc_id")
        # One row a hash leaves each task, however many documents share the line.
        keys = lines.groupBy(*HASH).agg(
            F.min(doc).alias("first"), F.max(doc).alias("last"), F.max(doc.isNull().cast("int")).alias("without_id")
        )
        batch = self._sorted(keys, "batch")
        stored = [run for runs in self.levels for run in runs]
        fresh = self.spark.table(batch)
        for run in stored:
            fresh = fresh.join(self.spark.table(run).select(*HASH), HASH, "left_anti")
        own = self._sorted(fresh, "run0") if stored else batch
        shared = (F.col("first") < F.col("last")) | (F.col("first").isNotNull() & (F.col("without_id") == 1))
        hits = self.spark.table(own).where(shared).select(*HASH, "first", F.lit(False).alias("stored"))
        if stored:
            seen = self.spark.table(batch).join(self.spark.table(own).select(*HASH), HASH, "left_anti")
            hits = hits.unionByName(seen.select(*HASH, "first", F.lit(True).alias("stored")))
        # Written, so that both sides of the next join are dealt by Spark, which splits a common line's rows.
        hits = written(hits, "line-hits")
        later = F.col("stored") | (F.col("first") < doc) | (F.col("first").isNotNull() & doc.isNull())
        drops = written(lines.join(hits, HASH).where(later).select(*ROW, "place"), "line-drops")
        if own != batch:
            self.spark.sql(f"drop table {batch}")
        self.levels = self.levels or [[]]
        self.levels[0].append(own)
        return drops


def _batched(lines: DataFrame, docs: DataFrame, batches: int) -> list[DataFrame]:
    """The lines, written once and parted into batches of ascending doc_id; rows without id are in the last."""
    shares = [k / batches for k in range(1, batches)]
    edges = docs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    edges = sorted(set(edges or []))
    number = F.when(F.col("doc_id").isNull(), F.lit(len(edges)))
    for k, edge in enumerate(edges):
        number = number.when(F.col("doc_id") <= edge, F.lit(k))
    number = number.otherwise(F.lit(len(edges)))
    folder = new_folder(docs.sparkSession, "lines")
    lines.withColumn("batch", number).write.partitionBy("batch").option("compression", "zstd").parquet(folder)
    back = docs.sparkSession.read.schema(T.StructType(lines.schema.fields).add("batch", T.IntegerType())).parquet(folder)
    return [back.where(F.col("batch") == k).drop("batch") for k in range(len(edges) + 1)]


def drop_repeated_lines(docs: DataFrame, least_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_lines, n_dropped, and kept_text without repeated lines.

    A text is split at \\n; a line's key is it without white space at its ends and with A-Z lower-cased. Lines whose
    key has at least `least_chars` code points stay only in the smallest doc_id that holds the key, and there all
    of them; shorter ones always stay. Documents go in as `batches` ranges of ascending ids, so that the earlier
    batch is the one that keeps a line. A null or empty text is one empty line. Rows without id count as one
    document after all others; rows that share an id count as one document, each keeping its own text. Other
    columns are ignored. Keys are compared by 128 bits of hash.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = LineRuns(docs.sparkSession, fanout)
    drops = [runs.add(part) for part in _batched(hashed_lines(docs, least_chars), docs, batches)]
    runs.close()
    # A set, since equal rows name the same places; its size is bounded by the lines of one text.
    places = reduce(DataFrame.unionByName, drops).groupBy(*ROW).agg(F.collect_set("place").alias("places"))
    places = written(places, "line-places").toDF("p_doc_id", "p_text_hash", "places")
    keyed = docs.withColumn("text_hash", _text_hash())
    same = keyed.doc_id.eqNullSafe(places.p_doc_id) & (keyed.text_hash == places.p_text_hash)
    joined = keyed.join(places, same, "left").select("doc_id", "text", "places", _lines_of(F.col("text")).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    left = F.array_join(F.transform(kept, lambda k: F.get("lines", k)), "\n")
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.coalesce("text", F.lit(""))).otherwise(left).alias("kept_text"),
    )


def line_digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the lowercase hex SHA-256 of the kept text's UTF-8."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
