"""From documents to token shards in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns a DataFrame that
is written as Parquet and read again as the next one's docs. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.columns import word_count
from cohortflow.llm.decontamination import overlaps
from cohortflow.llm.language_id import UNDETERMINED, identify
from cohortflow.llm.minhash_dedup import near_duplicates
from cohortflow.llm.queries import table, tokenizer_path
from cohortflow.llm.scratch import written
from cohortflow.llm.source_mixing import mix_sources
from cohortflow.llm.token_ids import read_token_ids, write_token_ids

# Text of any language learned costs two to five bits a byte; noise costs more.
MOST_BITS_PER_BYTE = 6.0
# Near duplicates share 80 % of their shingles; a pair at just that has fewer than 14 of 32 equal coordinates once in a million.
PERCENT, MATCHES = 80, 14
# Shorter benchmark items say too little to drop a document for.
LEAST_ITEM_WORDS = 5
KEY = "_key"
# Documents whose roundings make up for one another; hashes are fractions of this scale.
ROUNDED_TOGETHER, HASH_SCALE = 1024, 1 << 20


def _keyed(ids: DataFrame) -> DataFrame:
    """Distinct ids under a name that no column of documents has."""
    return ids.select(F.col("doc_id").alias(KEY)).distinct()


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter (null and empty ones too) and texts that are noise in every language."""
    found = identify(docs, carry=True)
    noise = F.coalesce(F.col("bits_per_byte") > MOST_BITS_PER_BYTE, F.lit(False))
    return found.where((F.col("lang_pred") != UNDETERMINED) & ~noise).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near duplicates, at 80 % of five-word shingles.

    Rows that share an id stand or fall together; of those that stay, every text stays once. Rows without an id
    stay all.
    """
    kept = _keyed(near_duplicates(docs, percent=PERCENT, matches=MATCHES).where("kept and doc_id is not null"))
    named = docs.withColumn(KEY, F.col("doc_id").cast("long")).join(kept, KEY, "left_semi")
    # Combined before the shuffle: a row that is there very often is one row per task.
    others = [name for name in docs.columns if name != "text"]
    first = F.min_by(F.struct(*others), F.xxhash64(*others)).alias("_row")
    once = named.groupBy(KEY, "text").agg(first).select(*["text" if c == "text" else f"_row.{c}" for c in docs.columns])
    return once.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of the benchmark's items of five words and more; rows that share an id go together."""
    found = _keyed(overlaps(docs, table(spark, sf_dir, "benchmark"), least_words=LEAST_ITEM_WORDS))
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(KEY)), "left_anti")


def _times_taken(mix: DataFrame, blocks: DataFrame) -> DataFrame:
    """Whole times that documents are repeated: number (of the source), doc_id, size, times.

    The words taken of a document over its size are rounded up or down, longest documents first. A seeded hash
    decides, against the fraction and the words that the roundings before gained or lost, so that in each bucket of
    documents of a source, errors do not add up but stay below the size of the last documents rounded.
    """
    drawn = mix.groupBy("number", "block").agg(F.count(F.lit(1)).alias("drawn"))
    # Both sides grow with the input: never broadcast.
    found = blocks.join(drawn.hint("merge"), ["number", "block"]).groupBy("number", "doc_id", "size")
    # A row's blocks add to its size; blocks that were not drawn are not here.
    taken = found.agg(F.sum(F.col("words") * F.col("drawn")).alias("taken"))
    rows = blocks.groupBy("number", "doc_id", "size").agg(F.sum("words").alias("all"))
    keys = [F.col(f"t.{k}").eqNullSafe(F.col(f"r.{k}")) for k in ("number", "doc_id", "size")]
    taken = taken.alias("t").join(rows.alias("r").hint("merge"), keys).select("t.*", "r.all")
    taken = written(taken.where("taken > 0"), "taken")
    many = taken.groupBy("number").agg(F.ceil(F.count(F.lit(1)) / F.lit(ROUNDED_TOGETHER)).alias("buckets"))
    # One row a source. Broadcast, it leaves the rows where they are, and the grouping deals them by source and bucket.
    taken = taken.join(F.broadcast(many), "number").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), "buckets"))
    chance = F.pmod(F.xxhash64("doc_id", "size", F.lit(5)), F.lit(HASH_SCALE))
    row = F.struct((-F.col("all")).alias("order"), "doc_id", "size", "all", F.expr("taken % all").alias("rest"),
                   F.expr("taken div all").alias("low"), chance.alias("chance"))
    groups = taken.groupBy("number", "bucket").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    up = f"x.rest > 0 and (s.left + x.rest) * {HASH_SCALE} > x.chance * x.all"
    groups = groups.withColumn("up", F.expr(f"""
        aggregate(rows, named_struct('left', 0L, 'up', ''), (s, x) -> if({up},
            named_struct('left', s.left + x.rest - x.all, 'up', concat(s.up, '1')),
            named_struct('left', s.left + x.rest, 'up', concat(s.up, '0')))).up
    """))
    each = groups.select("number", "up", F.posexplode("rows").alias("at", "x"))
    times = F.expr("cast(x.low + cast(substring(up, at + 1, 1) as int) as int)")
    return each.select("number", "x.doc_id", "x.size", times.alias("times"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes its words, rounded so that sources' totals stay on target.

    Documents of which no block was drawn, and those without words, go; so do documents rounded down to none.
    Rows that share an id, source and size share the sum.
    """
    source = F.col("source").cast("string").alias("_source")
    in_order = Window.orderBy(F.col("_source").asc_nulls_last())
    # One row per source, numbered as the mix does.
    sources = docs.select(source).distinct().withColumn("number", (F.row_number().over(in_order) - 1))
    times = _times_taken(*mix_sources(docs)).where("times > 0").join(sources, "number")
    times = times.select(F.col("doc_id").alias(KEY), "_source", F.col("size").alias("_size"), F.col("times").alias("_times"))
    size = word_count(F.col("text").cast("string"))
    worded = docs.select("*", F.col("doc_id").cast("long").alias("_id"), source.alias("_from"), size.alias("_words")).where("_words > 0")
    same = F.col("_id").eqNullSafe(F.col(KEY)) & F.col("_from").eqNullSafe(F.col("_source"))
    kept = worded.join(times, same & (F.col("_words") == F.col("_size")))
    return kept.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token ids as binary shards and gives what reading them back tells of each document."""
    return read_token_ids(write_token_ids(docs, tokenizer_path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("minhash_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_ids", token_stage),
]

# The context trees of the first stage cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
