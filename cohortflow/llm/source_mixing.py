"""Mixing sources to target weights, in blocks of words.

The texts of a source, one after another, are packed into blocks of a fixed number of words. The mix is a
sequence of block slots in output shards. Source counts per shard are multinomial draws conditioned on the
sources' totals: a pseudorandom permutation of all slots deals each source's slots over the shards, so totals
meet their targets to the block and no source can run over. A source's slots map to its blocks through a
pseudorandom permutation of the block numbers, pass after pass; slots and blocks are joined by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.columns import permuted, word_count
from cohortflow.llm.scratch import written

PIECE = 1 << 14


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Per source: number (by code point, null last), source_size, target.

    Targets are shares of `share` times all sizes by weight; a target stops at `most` times its source's size
    and the excess is shared again. Sorted by cap per weight, a source is capped when its fair part of what
    the capped ones before it leave reaches its cap.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    df = total.withColumn("number", F.row_number().over(order) - 1)
    df = df.withColumn("weight", F.get(wheel, F.pmod("number", F.lit(len(weights)))))
    df = df.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    df = df.withColumn("capped", F.col("weight") * left >= F.col("cap") * F.sum("weight").over(after))
    free = F.when(~F.col("capped"), F.col("weight"))
    spare = F.col("wanted") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0.0))
    level = spare / F.sum(free).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level)
    return df.withColumn("target", F.least(target, F.col("cap"))).select("source", "number", "source_size", "target")


def with_slots(targets: DataFrame, block_words: int, most: float) -> DataFrame:
    """Adds blocks and slots of each source, the number of slots before it and of all."""
    blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("bigint")
    df = targets.withColumn("blocks", blocks)
    wanted = F.when(F.col("blocks") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size")))
    slots = F.least(F.coalesce(wanted, F.lit(0)).cast("bigint"), F.floor(F.col("blocks") * F.lit(float(most))))
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumn("slots", slots.cast("bigint"))
    df = df.withColumn("slots_before", F.coalesce(F.sum("slots").over(before), F.lit(0)).cast("bigint"))
    return df.withColumn("all_slots", F.sum("slots").over(everything).cast("bigint"))


def slot_table(targets: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """One row per slot of the mix: shard, slot, number (of the source), block."""
    pieces = targets.where("slots > 0").select(
        "*", F.expr(f"explode(sequence(0L, slots - 1, {PIECE}L))").alias("low")
    )
    # A large source's slots start from one row: deal its pieces out before writing them in full. The number of
    # partitions is given, as the pieces are too small for adaptive execution to leave them apart.
    partitions = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(partitions, "number", "low")
    rows = pieces.select(
        "*", F.expr(f"explode(sequence(low, least(low + {PIECE - 1}, slots - 1)))").alias("j")
    )
    rows = rows.select(
        "number", "blocks", "all_slots",
        (F.col("slots_before") + F.col("j")).alias("place"),
        F.pmod(F.col("j"), F.col("blocks")).alias("turn"),
        F.expr("j div blocks").alias("pass"),
    )
    at = permuted("place", "all_slots", f"{seed}")
    block = permuted("turn", "blocks", f"xxhash64({seed}, number, pass)")
    rows = rows.select("number", at.alias("at"), block.alias("block"))
    shard = F.expr(f"at div {shard_slots}")
    return rows.select(shard.alias("shard"), F.pmod("at", F.lit(shard_slots)).alias("slot"), "number", "block")


def block_table(sizes: DataFrame, targets: DataFrame, block_words: int, rows_per_bucket: int) -> DataFrame:
    """Rows of `sizes` with start (words before it in its source) and one row for each block it reaches into.

    Columns: doc_id, number, source_size, target, size, row, start, block, words (null block: size 0). Starts
    are prefix sums in two levels, sums of hash buckets and sums inside a bucket, so that a large source is
    spread out. `row` numbers rows of equal id and size apart.
    """
    buckets = max(1, -(-sizes.count() // rows_per_bucket))
    df = sizes.join(targets, sizes.source.eqNullSafe(targets.source)).drop("source")
    df = df.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "mark"), F.lit(buckets)))
    sums = df.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "number", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start")
    )
    inside = Window.partitionBy("number", "bucket").orderBy("doc_id", "size", "mark")
    df = df.withColumn("row", F.row_number().over(inside))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("inside", F.sum("size").over(upto) - F.col("size"))
    df = df.join(sums, ["number", "bucket"])
    df = df.withColumn("start", F.col("bucket_start") + F.col("inside"))
    first, last = f"start div {block_words}", f"(start + size - 1) div {block_words}"
    reach = f"if(size > 0, sequence({first}, {last}), array(cast(null as bigint)))"
    df = df.select("doc_id", "number", "source_size", "target", "size", "bucket", "row", "start",
                   F.explode(F.expr(reach)).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return df.withColumn("words", F.coalesce(high - low, F.lit(0)))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 128,
    shard_slots: int = 8192,
    rows_per_bucket: int = 8192,
    seed: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """(mix, blocks): the slots of the mix, and the blocks with the documents in them.

    mix has shard, slot, number, block; blocks has doc_id, number, source_size, target, size, row, start, block,
    words. Joined on (number, block) they say which words of which document stand in each slot. Sources, by code
    point with null last, take `weights` in turn. A null text has size 0, lies in no block, and is kept in
    `blocks` with a null one. Null and repeated ids are rows of their own. The last block of a source may be
    short. Same rows, same mix, whatever the partitioning. Other columns are ignored.
    """
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        # Tells rows without id, or with equal ids, apart: they spread over the buckets.
        F.xxhash64(F.col("text").cast("string")).alias("mark"),
    )
    sizes = written(sizes, "sizes")
    targets = written(with_slots(source_targets(sizes, weights, share, most), block_words, most), "targets")
    blocks = block_table(sizes, targets.select("source", "number", "source_size", "target"), block_words, rows_per_bucket)
    return slot_table(targets, shard_slots, seed), blocks


def words_taken(mix: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken (words in the mix, repeats counted)."""
    times = mix.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    # Both sides grow with the input: never broadcast.
    found = blocks.join(times.hint("merge"), ["number", "block"], "left")
    taken = F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")
    keys = ["doc_id", "number", "bucket", "row", "size", "source_size", "target"]
    return found.groupBy(*keys).agg(taken).select("doc_id", "size", "source_size", "target", "taken")
