"""Repeated passages by content-defined chunking with a gear rolling hash.

The hash of a place depends on the 16 bytes before it alone, so chunks start at the same words wherever a
passage stands, and an insertion changes only the chunks it touches. Chunks are deduplicated by digest.
Runs of neighbouring chunks have a key of their own; chunks are joined to spans by runs that occur elsewhere in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm import words
from cohortflow.llm.scratch import written

WINDOW = 16
# A place in 16 is a candidate cut; one with another less than 8 bytes before it is none. Mean chunk: 25 bytes.
CUT_BITS, LEAST, MOST = 4, 8, 128
GEAR = np.random.default_rng(16).integers(0, 1 << 32, 256, dtype=np.uint32)
CHUNK_SCHEMA = "digest long, doc_id long, place long"
RUN_SCHEMA = "doc_id long, key long, start long, end long"
# A place has bits of its text's hash, which part texts that share an id, then the chunk's start and its length.
LENGTH_BITS, START_BITS, TEXT_BITS = 9, 32, 22
TEXT = START_BITS + LENGTH_BITS
START = f"shiftright(place, {LENGTH_BITS}) & {(1 << START_BITS) - 1}"
# Runs are hashed as polynomials of their chunks' digests, modulo 2^64.
BASE = 0x9E3779B97F4A7C15


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the chunks of all texts, in order. Chunks never split a character."""
    rolled = GEAR[data]
    for width in (1, 2, 4, 8):  # after each step, a place has the hash of the last 2 * width bytes
        shifted = rolled[:-width] << np.uint32(width)
        rolled = rolled.copy()
        rolled[width:] += shifted
    whole = (data & 0xC0) != 0x80  # not inside a character
    cuts = np.flatnonzero(rolled[:-1] >> np.uint32(32 - CUT_BITS) == 0) + 1
    firsts = offsets[:-1]
    text = np.searchsorted(offsets, cuts, side="right") - 1
    cuts = cuts[(cuts - offsets[text] >= WINDOW) & whole[cuts]]
    cuts = cuts[np.diff(cuts, prepend=-MOST) >= LEAST]
    starts = np.union1d(firsts[firsts < len(data)], cuts)
    length = np.diff(starts, append=len(data))
    long = np.flatnonzero(length > MOST)
    more = (length[long] - 1) // MOST
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    extra = np.repeat(starts[long], more) + MOST * step
    for _ in range(3):
        inside = np.flatnonzero(~whole[np.minimum(extra, len(data) - 1)])
        extra[inside] += 1
    return np.union1d(starts, extra[extra < len(data)])


def run_hashes(digest: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of digests from `first` to `last`, the same wherever a run stands."""
    powers = np.ones((2, len(digest)), dtype=np.uint64)
    for row, base in zip(powers, (BASE, pow(BASE, -1, 1 << 64))):
        row[1:] = np.cumprod(np.full(len(digest) - 1, base, dtype=np.uint64))
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digest * powers[0])])
    return words.mix((upto[last + 1] - upto[first]) * powers[1][first] ^ (last - first).astype(np.uint64))


def _chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, last in words.slices(batch.column("text")):
            data, offsets = words.text_bytes(batch.column("text").slice(first, last - first))
            if not len(data):
                continue
            starts = chunk_starts(data, offsets)
            ends = np.append(starts[1:], len(data))
            text = np.searchsorted(offsets, starts, side="right") - 1
            start, digest = starts - offsets[text], words.hash_spans(data, starts, ends)
            # A text's hash is made of its chunks and their places.
            heads = np.flatnonzero(np.diff(text, prepend=-1))
            whole = words.mix(np.add.reduceat(words.mix(digest ^ start.astype(np.uint64)), heads))
            tag = (whole >> np.uint64(64 - TEXT_BITS)).astype(np.int64)[np.searchsorted(heads, np.arange(len(text)), side="right") - 1]
            place = tag << TEXT | start << LENGTH_BITS | (ends - starts)
            owner = ids.slice(first, last - first).take(pa.array(text))
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), owner, pa.array(place)], names=["digest", "doc_id", "place"])


def chunk_table(docs: DataFrame) -> DataFrame:
    """One row per chunk of a text: digest, doc_id and place (see above)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.where("doc_id is not null").mapInArrow(_chunk, CHUNK_SCHEMA)


def runs_of(doc: np.ndarray, place: np.ndarray, digest: np.ndarray, least_bytes: int) -> tuple[np.ndarray, ...]:
    """(row, key, start, end) of all runs: for every chunk the shortest of `least_bytes` bytes that begins, and the
    shortest that ends, with it. Rows are sorted by document and place; runs never leave a row of adjoining chunks."""
    start = place >> LENGTH_BITS & ((1 << START_BITS) - 1)
    end = start + (place & ((1 << LENGTH_BITS) - 1))
    text = place >> TEXT
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] != end[:-1])
    part = np.cumsum(new) - 1
    # Places on one line: every row of adjoining chunks is moved behind the one before.
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(doc)) - 1
    length = end[tails] - start[heads]
    moved = (np.cumsum(length) - length - start[heads])[part]
    low, high = start + moved, end + moved
    at = np.arange(len(doc))
    to = np.searchsorted(high, low + least_bytes)
    fits = to < len(doc)
    fits[fits] = part[to[fits]] == part[fits]
    since = np.searchsorted(low, high - least_bytes, side="right") - 1
    held = since >= 0
    held[held] = part[since[held]] == part[held]
    first, last = np.concatenate([at[fits], since[held]]), np.concatenate([to[fits], at[held]])
    return first, run_hashes(digest.view(np.uint64), first, last).view(np.int64), start[first], end[last]


def _run_builder(least_bytes: int) -> Callable:
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), dtype=np.int64)
        for batch in chain(batches, [None]):
            if batch is not None:
                new = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in ("doc_id", "place", "digest")])
                # Equal rows stand side by side; chunks of one place are one occurrence.
                held = np.concatenate([held, new], axis=1)
                held = held[:, np.append(True, (held[:, 1:] != held[:, :-1]).any(axis=0))] if held.shape[1] else held
                if not held.shape[1]:
                    continue
                # The last text may go on in the next batch.
                doc, text = held[0], held[1] >> TEXT
                other = np.flatnonzero((doc != doc[-1]) | (text != text[-1]))
                whole = int(other[-1]) + 1 if len(other) else 0
            else:
                whole = held.shape[1]
            if whole:
                doc, place, digest = held[:, :whole]
                row, key, start, end = runs_of(doc, place, digest, least_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[row], key, start, end)], names=["doc_id", "key", "start", "end"])
            held = held[:, whole:]

    return build


def repeated_spans(docs: DataFrame, least_bytes: int = 100, within: bool = False) -> DataFrame:
    """Spans that documents share: one row per span of a document, none for documents without.

    Columns: doc_id, start and end (bytes of the UTF-8 text), chunks, removed_bytes (bytes of chunks that a
    document with a smaller doc_id has too: what a deduplicated text loses), first_doc_id (smallest doc_id with a chunk of the span).
    A span is made of overlapping runs of neighbouring chunks, each `least_bytes` long or longer and each found in
    full, as a run, in another document; chunks at the ends of a shared passage that reach beyond it are not in
    it, about 60 bytes together. With `within`, runs repeated inside one document count too: only the first
    occurrence of a chunk, by doc_id and place, is kept, and every later one is removed. Text that repeats a word
    for hundreds of bytes may have no content-defined cuts, and its chunks then agree only if they start alike.
    Null and empty texts and null ids have no spans. Rows that share an id are one document, and chunks at the same
    place in them one occurrence. Other columns are ignored. A 64-bit digest stands for a chunk, or a run.
    """
    chunks = chunk_table(docs).withColumn("start", F.expr(START))
    occurrence = F.struct("doc_id", "start") if within else F.struct("doc_id")
    ends = [F.min(occurrence).alias("first"), F.max(occurrence).alias("last")]
    # Combined before the shuffle, so that a chunk found everywhere is one row per task.
    shared = chunks.groupBy("digest").agg(*ends).where("first < last").select("digest", "first")
    # Read back, so that Spark deals out both sides of the join and can split a chunk found very often.
    shared = written(shared, "shared-chunks")
    found = chunks.drop("start").join(shared, "digest").withColumn("start", F.expr(START))
    found = found.select(
        "digest", "doc_id", "place", "start",
        (F.col("start") + F.expr(f"place & {(1 << LENGTH_BITS) - 1}")).alias("end"),
        F.col("first.doc_id").alias("first_doc_id"),
        (occurrence != F.col("first")).alias("later"),
    )
    found = written(found, "found-chunks")
    # Chunks of a repeated run are repeated, so runs are made of found chunks that adjoin. 24 bytes a row are sorted.
    lined_up = found.select("doc_id", "place", "digest").repartition("doc_id", F.expr(f"shiftright(place, {TEXT})"))
    lined_up = lined_up.sortWithinPartitions("doc_id", "place", "digest")
    runs = written(lined_up.mapInArrow(_run_builder(least_bytes), RUN_SCHEMA), "runs")
    repeated = written(runs.groupBy("key").agg(*ends).where("first < last").select("key"), "shared-runs")
    runs = runs.join(repeated, "key").select("doc_id", "start", "end", F.lit(True).alias("is_run"))
    rows = runs.unionByName(found.drop("digest", "place"), allowMissingColumns=True)
    rows = rows.withColumn("is_run", F.coalesce("is_run", F.lit(False)))
    order = Window.partitionBy("doc_id").orderBy("start", F.desc("is_run"), "end", "first_doc_id")
    same = F.struct("start", "end", "is_run", "first_doc_id")
    rows = rows.withColumn("again", same.eqNullSafe(F.lag(same).over(order)))
    run_end = F.when(F.col("is_run"), F.col("end"))
    rows = rows.withColumn("reached", F.max(run_end).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.col("is_run") & F.coalesce(F.col("start") >= F.col("reached"), F.lit(True))
    rows = rows.withColumn("run", F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = rows.where("not is_run and not again and end <= reached").groupBy("doc_id", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.when(F.col("later"), F.col("end") - F.col("start")).otherwise(0)).alias("removed_bytes"),
        F.min("first_doc_id").alias("first_doc_id"),
    )
    return spans.drop("run")
