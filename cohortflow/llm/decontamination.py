"""Benchmark decontamination by spaced-seed hashing.

A mask of ones and zeros slides over the words of test items and training texts; the words under its ones are
hashed, those under zeros are free to differ. Equal hashes are hits. Around a hit the two word sequences are
laid side by side over all the words they share, however many, and the best stretch is found: one point for an
equal word, one off for a different one. Of hits one place after another only the first is followed.
Items shorter than a mask are looked up by their whole word sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ("111010011", "110011101")
# The bit table: bits a seed, and its least and most bits. Beyond them more places become rows, which the join drops.
BITS_PER_SEED, LEAST_BITS, MOST_BITS = 32, 1 << 21, 1 << 27
# The mask number of seeds made of a whole item.
WHOLE = -1


def normal_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; none for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def hashed_words(df: DataFrame, *keep: str) -> DataFrame:
    """df's columns `keep` and h, the hashes of the words of its text."""
    return df.select(*keep, F.transform(normal_words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))


def seed_hash(mask: str, at: str) -> str:
    """SQL: hash of the words of h under the mask's ones, the mask starting at `at`."""
    under = ", ".join(f"h[{at} + {k}]" for k, bit in enumerate(mask) if bit == "1")
    return f"xxhash64({under}, {MASKS.index(mask)})"


def whole_hash(at: str, size: str) -> str:
    """SQL: hash of `size` words of h from `at`, for items shorter than a mask."""
    return f"xxhash64(slice(h, {at} + 1, {size}), {size}, {len(MASKS)})"


def item_words(benchmark: DataFrame, least_score: int, least_words: int) -> DataFrame:
    """Distinct items of `least_words` words and more: item_id, h, item (a hash of both), needed (score)."""
    span = len(MASKS[0])
    items = hashed_words(benchmark, "item_id").where(F.size("h") >= max(least_words, 1)).distinct()
    needed = F.expr(f"if(size(h) < {span}, size(h), least({least_score}, size(h) div 2))").alias("needed")
    return items.select("item_id", "h", F.xxhash64(F.isnull("item_id"), "item_id", "h").alias("item"), needed)


def item_seeds(items: DataFrame) -> DataFrame:
    """One row per item, place and mask, one per item shorter than a mask: item, seed, q (place), mask."""
    span = len(MASKS[0])
    places = items.select("item", "h", F.expr(f"explode(if(size(h) < {span}, array(0), sequence(0, size(h) - {span})))").alias("q"))
    masked = F.array(*[F.struct(F.expr(seed_hash(mask, "q")).alias("seed"), F.lit(m).alias("mask")) for m, mask in enumerate(MASKS)])
    whole = F.array(F.struct(F.expr(whole_hash("0", "size(h)")).alias("seed"), F.lit(WHOLE).alias("mask")))
    seeds = places.select("item", "q", F.explode(F.when(F.size("h") < span, whole).otherwise(masked)).alias("s"))
    return seeds.select("item", "s.seed", "q", "s.mask")


def item_sizes(items: DataFrame) -> DataFrame:
    """One row: the numbers of words that items shorter than a mask have, and that of the longest item."""
    short = F.when(F.size("h") < len(MASKS[0]), F.size("h"))
    longest = F.coalesce(F.max(F.size("h")), F.lit(0)).alias("longest")
    return items.groupBy().agg(F.struct(F.sort_array(F.collect_set(short)).alias("short"), longest).alias("sizes"))


def seed_bits(seeds: DataFrame, bits: int) -> DataFrame:
    """One row, one array of bits / 64 longs: two bits per seed are set."""
    lanes = bits // 64
    places = seeds.select(F.explode(F.array("seed", F.expr("shiftrightunsigned(seed, 32)"))).alias("p"))
    places = places.select(F.expr(f"shiftright(p, 6) & {lanes - 1}").alias("lane"), F.expr("cast(p & 63 as int)").alias("bit"))
    set_bits = places.distinct().groupBy("lane").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    every = seeds.sparkSession.range(lanes).withColumnRenamed("id", "lane")
    full = every.join(set_bits, "lane", "left").select("lane", F.coalesce("bits", F.lit(0)).alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("lane", "bits")))
    return full.groupBy().agg(F.transform(in_order, lambda x: x["bits"]).alias("bits"))


def _follows(near: str, at: str, other: str, other_at: str) -> str:
    """SQL: whether the place before is a hit of the same mask too, so that the same words are laid side by side."""
    hit = [
        f"mask = {m} and " + " and ".join(f"{near}[{at} + {k - 1}] = {other}[{other_at} + {k - 1}]" for k, bit in enumerate(mask) if bit == "1")
        for m, mask in enumerate(MASKS)
    ]
    return f"{at} > 0 and {other_at} > 0 and ({' or '.join(hit)})"


def _best_stretch(near: str, at: str, other: str, other_at: str) -> Column:
    """Score, length, equal words and start (from the hit) of the best stretch around a hit."""
    left = f"least({at}, {other_at})"
    right = f"least(size({near}) - {at}, size({other}) - {other_at})"
    return F.expr(f"""
        aggregate(
            sequence(-{left}, {right} - 1),
            named_struct('score', 0, 'equal', 0, 'length', 0, 'best', 0, 'best_equal', 0, 'best_length', 0, 'best_end', 0),
            (s, k) -> element_at(transform(
                array(if({near}[{at} + k] = {other}[{other_at} + k], 1, -1)),
                p -> if(s.score + p <= 0,
                    named_struct('score', 0, 'equal', 0, 'length', 0, 'best', s.best, 'best_equal', s.best_equal,
                                 'best_length', s.best_length, 'best_end', s.best_end),
                    named_struct('score', s.score + p, 'equal', s.equal + if(p = 1, 1, 0), 'length', s.length + 1,
                        'best', greatest(s.best, s.score + p),
                        'best_equal', if(s.score + p > s.best, s.equal + if(p = 1, 1, 0), s.best_equal),
                        'best_length', if(s.score + p > s.best, s.length + 1, s.best_length),
                        'best_end', if(s.score + p > s.best, k + 1, s.best_end)))), 1),
            s -> named_struct('score', s.best, 'equal_words', s.best_equal, 'words', s.best_length,
                              'start', s.best_end - s.best_length))
    """)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, least_score: int = 10, least_words: int = 1, filter_bits: int | None = None
) -> DataFrame:
    """Documents that hold passages of benchmark items: one row per pair of doc_id and item_id.

    Columns: doc_id, item_id, score, equal_words, words (of the best stretch) and position (its first word in
    the document). A pair is reported when the best stretch around some hit scores at least `least_score`: ten
    equal words, or one more for every different one among them; for items of fewer than twice as many words, half
    their number is enough. An item shorter than a mask (9 words) is reported where all its words stand in a row; items
    of fewer than `least_words` words are not looked for, as a common word alone would match nearly every text.
    Words are runs of letters and digits in lower case. Texts and items without any have no hits. Null ids
    are reported as null; rows that share an id are reported together. Other columns are ignored.

    Every place of every text is tested against a bit table that follows the number of seeds (`filter_bits` sets
    it, in a power of two), which drops nearly all places without a hit and none with one; only the rest become
    rows. Such a row holds the words around its place as far as the longest item reaches.
    """
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = item_words(benchmark, least_score, least_words)
    seeds = item_seeds(items)
    if filter_bits is None:
        wanted = max(seeds.count() * BITS_PER_SEED, 1)
        filter_bits = min(max(1 << (wanted - 1).bit_length(), LEAST_BITS), MOST_BITS)
    span, lanes = len(MASKS[0]), filter_bits // 64
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = hashed_words(texts, "doc_id")
    texts = texts.withColumn("bits", seed_bits(seeds, filter_bits).scalar())
    texts = texts.withColumn("sizes", item_sizes(items).scalar())

    def is_set(p: str) -> str:
        return f"(shiftrightunsigned(bits[cast(shiftright({p}, 6) & {lanes - 1} as int)], cast({p} & 63 as int)) & 1L) = 1L"

    both = f"{is_set('x')} and {is_set('shiftrightunsigned(x, 32)')}"
    def may_hit(seed: str) -> str:
        return f"element_at(transform(array({seed}), x -> {both}), 1)"

    def every(size: str) -> str:
        return f"if(size(h) < {size}, cast(array() as array<int>), sequence(0, size(h) - {size}))"

    # A place with size 0 is one of the masks, others are those of whole items of that many words.
    tested = " or ".join(may_hit(seed_hash(mask, "i")) for mask in MASKS)
    masked = f"transform(filter({every(str(span))}, i -> {tested}), i -> struct(i, 0 as n))"
    whole = f"filter({every('n')}, i -> {may_hit(whole_hash('i', 'n'))})"
    whole = f"flatten(transform(sizes.short, n -> transform({whole}, i -> struct(i, n))))"
    texts = texts.select("doc_id", "h", "sizes.longest", F.expr(f"concat({masked}, {whole})").alias("places"))
    # An outer explode: a filter on h or places would be moved below their computation and repeat it.
    places = texts.select("doc_id", "h", "longest", F.explode_outer("places").alias("p")).where("p is not null")
    places = places.select("doc_id", "h", "longest", "p.i", "p.n")
    mine = F.array(*[F.expr(seed_hash(mask, "i")) for mask in MASKS])
    mine = F.when(F.col("n") == 0, mine).otherwise(F.array(F.expr(whole_hash("i", "n"))))
    at = F.expr("least(i, longest)").alias("at")
    near = F.expr("slice(h, i - least(i, longest) + 1, least(i, longest) + longest)").alias("near")
    places = places.select("doc_id", "i", F.explode(mine).alias("seed"), near, at)
    theirs = items.select("item", "item_id", F.col("h").alias("item_h"), "needed")
    hits = places.join(seeds, "seed").join(theirs, "item")
    hits = hits.where(~F.expr(_follows("near", "at", "item_h", "q")))
    found = hits.select("doc_id", "item_id", "i", "needed", _best_stretch("near", "at", "item_h", "q").alias("s"))
    found = found.where(F.col("s.score") >= F.col("needed"))
    position = F.col("i") + F.col("s.start")
    best = F.max(F.struct(F.col("s.score"), F.col("s.equal_words"), F.col("s.words"), (-position).alias("place")))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select("doc_id", "item_id", "b.score", "b.equal_words", "b.words", (-F.col("b.place")).alias("position"))
