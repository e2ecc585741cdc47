"""Language identification by prediction by partial matching.

Each language has a byte context tree of contexts of up to three bytes. In a context seen n times with d
different next bytes, a byte seen c times has probability c / (n + d); the escape, d / (n + d), is shared by
the other bytes in the proportions of the next shorter context, down to a uniform one. Statistics are frozen
after fitting, so the code length of every (context, byte) is a table entry and a text's length is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import words
from cohortflow.llm.shared import shared

ORDER = 3
STEP = 1 << 18
COUNT_SCHEMA = "lang string, gram long, n long"
SCORE_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"
UNDETERMINED = "und"


def bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo `buckets`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def _lagged(data: np.ndarray, offsets: np.ndarray, lag: int, start: int) -> np.ndarray:
    """The byte `lag` places earlier in the same text, or `start` before its beginning."""
    out = np.empty_like(data)
    out[lag:] = data[:-lag] if lag < len(data) else data[:0]
    out[:lag] = start
    firsts, sizes = offsets[:-1], np.diff(offsets)
    for k in range(lag):
        out[firsts[sizes > k] + k] = start
    return out


# -- fitting --------------------------------------------------------------------------------------


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four-byte sequences by language; three zero bytes stand before each text."""
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            text = batch.column("text").filter(pa.array(langs == lang))
            for first, last in words.slices(text):
                data, offsets = words.text_bytes(text.slice(first, last - first))
                data = words.LOWER[data]
                gram = data.astype(np.int64)
                for lag in range(1, ORDER + 1):
                    gram |= _lagged(data, offsets, lag, 0).astype(np.int64) << (8 * lag)
                grams, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)],
                    names=["lang", "gram", "n"],
                )


@dataclass
class ContextTrees:
    """Frozen statistics of all languages as tables.

    symbol: byte to column; state: the last three symbols to a row; bits: code length of each symbol after
    each row's context, by language.
    """

    langs: list[str]
    symbol: np.ndarray
    width: int
    state: np.ndarray
    bits: np.ndarray

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language; equal for all languages, 0, if it has no bytes."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        symbols = self.symbol[words.LOWER[data]]
        before = [_lagged(symbols, offsets, lag, self.symbol[0]) for lag in range(1, ORDER + 1)]
        table = self.bits.reshape(-1, len(self.langs))
        for low in range(0, len(data), STEP):
            here = slice(low, low + STEP)
            at = np.zeros(len(symbols[here]), dtype=np.int64)
            for lag in reversed(before):
                at = at * self.width + lag[here]
            cost = table[self.state[at].astype(np.int64) * self.width + symbols[here]]
            rows = np.arange(np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, low + len(at)))
            cuts = np.clip(offsets[rows], low, low + len(at)) - low
            full = np.flatnonzero(np.diff(np.append(cuts, len(at))) > 0)
            out[rows[full]] += np.add.reduceat(cost, cuts[full], axis=0, dtype=np.float64)
        return out


def build_trees(counts: pa.Table | list[tuple[str, int, int]], cells: int = 1 << 24) -> ContextTrees | None:
    """Trees from rows of language, four-byte sequence, count, as a table or as tuples; None without any.

    The tables have at most about `cells` entries: of the contexts of three and two bytes the most frequent
    are kept, and a dropped one is scored by its next shorter context. The rows of the longest contexts, most of
    all, are made `STEP` entries at a time, so little more than the finished tables is held.
    """
    if not isinstance(counts, pa.Table):
        counts = pa.table({"lang": [c[0] for c in counts], "gram": [c[1] for c in counts], "n": [c[2] for c in counts]})
    if not counts.num_rows:
        return None
    coded_langs = counts["lang"].combine_chunks().dictionary_encode()
    found = coded_langs.dictionary.to_pylist()
    langs = sorted(found)
    which = np.array([langs.index(lang) for lang in found])[coded_langs.indices.to_numpy()]
    grams = counts["gram"].to_numpy()
    n = counts["n"].to_numpy().astype(np.float64)
    parts = [(grams >> (8 * k) & 255).astype(np.uint8) for k in range(ORDER, -1, -1)]
    seen = np.union1d(np.unique(np.concatenate([np.unique(part) for part in parts])), [0])
    symbol = np.full(256, len(seen), dtype=np.int64)  # the last column: any byte never seen
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    coded = [symbol[part] for part in parts]
    most = max(1, cells // (width * len(langs)))

    # The empty context, below it 256 equally likely bytes.
    unseen = 256 - len(seen)
    below = np.full((1, len(langs), width), 1 / 256)
    below[:, :, -1] = max(unseen, 1) / 256
    chances, state, rows_before = below, np.zeros(1, dtype=np.int32), 0

    def bits_of(chance: np.ndarray) -> np.ndarray:
        chance[:, :, -1] /= max(unseen, 1)  # one byte's share of the last column
        return -np.log2(np.maximum(chance, 1e-30)).astype(np.float32).transpose(0, 2, 1)

    for order in range(ORDER + 1):
        context = np.zeros(len(grams), dtype=np.int64)
        for k in range(ORDER - order, ORDER):
            context = context * width + coded[k]
        known, at = np.unique(context, return_inverse=True)
        if len(known) > most:
            total = np.bincount(at, weights=n)
            keep = np.sort(np.argsort(-total, kind="stable")[:most])
            place = np.full(len(known), -1)
            place[keep] = np.arange(len(keep))
            known, at = known[keep], place[at]
        in_order = np.argsort(at, kind="stable")
        in_order = in_order[np.searchsorted(at[in_order], 0) :]
        # The shorter context's distribution, for each known context.
        shorter = state[known % (width ** max(order - 1, 0))] if order else np.zeros(len(known), dtype=np.int64)
        rows = max(1, STEP // (width * len(langs)))
        made = []
        for low in range(0, len(known), rows):
            some = shorter[low : low + rows]
            mine = in_order[slice(*np.searchsorted(at[in_order], [low, low + len(some)]))]
            count = np.zeros((len(some), len(langs), width))
            np.add.at(count, (at[mine] - low, which[mine], coded[-1][mine]), n[mine])
            prior = chances[some]
            had = count > 0
            total, distinct = count.sum(2, keepdims=True), had.sum(2, keepdims=True)
            rest = 1 - (prior * had).sum(2, keepdims=True)
            escape = np.divide(distinct, total + distinct, out=np.ones_like(total), where=total > 0)
            spread = np.where(rest > 1e-12, prior / np.maximum(rest, 1e-12), prior)
            chance = np.where(had, np.divide(count, total + distinct, out=np.zeros_like(count), where=total > 0),
                              escape * spread)
            made.append(chance if order < ORDER else bits_of(chance))
        if order < ORDER:
            chances = np.concatenate([*([chances] if order else []), *made])
        longer = np.tile(state, width) if order else np.zeros(1, dtype=np.int32)
        longer[known] = rows_before + np.arange(len(known))
        state, rows_before = longer, rows_before + len(known)
    bits = np.empty((rows_before, width, len(langs)), dtype=np.float32)
    at = 0
    for part in (bits_of(chances), *made):
        bits[at : at + len(part)] = part
        at += len(part)
    return ContextTrees(langs, symbol, width, state, bits)


def fit(docs: DataFrame, learn: Column, rows_per_lang: int, cells: int = 1 << 24) -> ContextTrees | None:
    """Trees from about `rows_per_lang` texts of each language among the rows where `learn` holds.

    The rows are those whose hashed id is below a rate set by the language's count, so the sample is bounded
    and the same on every run. What reaches the driver is bounded by the sample's distinct sequences, the
    tables by `cells`.
    """
    usable = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = usable.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return None
    scale = 1 << 30
    rates = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], int(min(1.0, rows_per_lang / r["count"]) * scale))])
    drawn = usable.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(scale)) < rates[F.col("lang")])
    counts = drawn.select("lang", "text").mapInArrow(_count, COUNT_SCHEMA).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return build_trees(counts.toArrow(), cells)


# -- prediction -----------------------------------------------------------------------------------


def identify(
    docs: DataFrame, rows_per_lang: int = 400, buckets: int = 4, held_out_bucket: int = 2, carry: bool = False
) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): doc_id, held_out, lang_pred, score, bits_per_byte.

    Learns from text and lang of rows whose crc32(doc_id as text) modulo `buckets` is not `held_out_bucket`,
    of about `rows_per_lang` of them per language (the bound of the sample). Predicts the language with the
    shortest code for the whole text, ties going to the first name; score is that language's posterior under
    equal priors. A null text, one without any letter, and every text if nothing could be learned, is "und"
    with score 0 and no bits_per_byte. A null doc_id counts as empty text in the split. Other columns are
    ignored, and lang, source and doc_id never enter a prediction. With `carry`, a last column `row` has the
    whole input row, so that filters need no join.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if carry else None
    carried = ["row"] if carry else []
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        *([whole] if carry else []),
    )
    schema = SCORE_SCHEMA + (f", row {docs.schema['row'].dataType.simpleString()}" if carry else "")
    held_out = bucket(F.col("doc_id"), buckets) == held_out_bucket
    trees = shared(docs.sparkSession, fit(docs, ~held_out, rows_per_lang))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ContextTrees | None = trees()
        names = np.array([*(model.langs if model else []), UNDETERMINED], dtype=object)
        for batch in batches:
            for first, last in words.slices(batch.column("text")):
                rows = last - first
                part = batch.slice(first, rows)
                lettered = part.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                best, posterior, per_byte = np.full(rows, len(names) - 1), np.zeros(rows), np.full(rows, np.nan)
                if model:
                    data, offsets = words.text_bytes(part.column("text"))
                    bits = model.code_lengths(data, offsets)
                    low = bits.argmin(axis=1)
                    ahead = bits - bits[np.arange(rows), low][:, None]
                    best = np.where(lettered, low, best)
                    posterior = np.where(lettered, 1 / np.exp2(-np.minimum(ahead, 1000)).sum(axis=1), 0.0)
                    size = np.maximum(np.diff(offsets), 1)
                    per_byte = np.where(lettered, bits[np.arange(rows), low] / size, np.nan)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names[best], pa.string()),
                     pa.array(posterior), pa.array(per_byte, mask=np.isnan(per_byte)),
                     *(part.column(c) for c in carried)],
                    names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte", *carried],
                )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held_out.alias("held_out"), "text", lettered.alias("lettered"), *carried).mapInArrow(
        score, schema
    )
