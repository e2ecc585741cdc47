"""Token counts by a map-side two-tier lookup: no pre-token is shuffled.

Tier one is a broadcast table of frequent pre-tokens and their lengths in tokens, gathered from a bounded
sample. Tier two is each worker's own bounded cache, filled by encoding the pre-tokens that tier one lacks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import words
from cohortflow.llm.pretokens import PretokenEncoder
from cohortflow.llm.shared import shared

COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _texts(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()


def frequent_pretokens(docs: DataFrame, encoder: PretokenEncoder, sample_rows: int, entries: int) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of about `sample_rows` rows.

    Each task hands over its `entries` most frequent ones at most, so the driver gets a bounded number.
    Only speed depends on the sample.
    """
    total = docs.count()
    if not total:
        return {}
    share = min(1.0, sample_rows / total)
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in _texts(batch.column("text")):
                seen.update(encoder.chunks(text) or ())
            if len(seen) > 8 * entries:
                seen = Counter(dict(seen.most_common(4 * entries)))
        top = [x for x in seen.most_common(entries) if x[1] > 1]
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array([x[0] for x in top], pa.string()), "n": pa.array([x[1] for x in top], pa.int64())}
        )

    seen: Counter = Counter()
    for row in picked.select("text").mapInArrow(count, "piece string, n long").toLocalIterator():
        seen[row.piece] += row.n
        if len(seen) > 8 * entries:
            seen = Counter(dict(seen.most_common(4 * entries)))
    pieces = [x for x, _ in seen.most_common(entries)]
    return {piece: encoder.value_of(piece) for piece in pieces}


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 512,
    sample_rows: int = 1024,
    table_entries: int = 16_384,
    cache_entries: int = 400_000,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    n_tokens is what the tokenizers library gives for the vocabulary at `tokenizer_path` (read on the driver)
    without added special tokens; special strings inside texts are handled as by its default. Null and empty
    texts have 0 bytes and 0 tokens. Rows with null or repeated ids are counted each on its own. Other columns
    are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    known = frequent_pretokens(docs, PretokenEncoder(spec, cache_entries, len, sum), sample_rows, table_entries)
    held = shared(docs.sparkSession, PretokenEncoder(spec, cache_entries, len, sum, known))

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held()
        for batch in batches:
            for first, last in words.slices(batch.column("text")):
                text = batch.column("text").slice(first, last - first)
                counts = encoder.values(_texts(text))
                size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), size, pa.array(counts, pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return docs.mapInArrow(lengths, COUNT_SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
