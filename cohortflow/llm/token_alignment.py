"""Alignment of two tokenizers' tokens by lockstep vectorised merging.

A slice of documents is cut into stretches of equal length in bytes, each with a pointer into the tokens of A and one
into those of B. One numpy state vector moves the pointers of all stretches of all documents at once: in a step each
stretch compares the ends of its two tokens, the earlier one gives way, and equal ends give a cut and a link.
Stretches that are through leave the vector. A very long document is many stretches, so it adds no steps.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import words
from cohortflow.llm.pretokens import PretokenEncoder, byte_characters
from cohortflow.llm.scratch import written
from cohortflow.llm.shared import shared

STRETCH_BYTES = 256
ID = np.dtype("<u4")
ALIGNED_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


@dataclass
class Tokens:
    """The tokens of many texts in a row: ids, their byte lengths, and the number of tokens before each text."""

    ids: np.ndarray
    length: np.ndarray
    before: np.ndarray

    def ends(self) -> np.ndarray:
        return np.cumsum(self.length)


@dataclass
class Lists:
    """Many lists of ids in a row, and the number of ids before each."""

    ids: np.ndarray
    before: np.ndarray

    def __add__(self, lists: list[list[int]]) -> Lists:
        more = np.fromiter(chain.from_iterable(lists), dtype=np.int32)
        return Lists(np.concatenate([self.ids, more]), np.concatenate([self.before, self.before[-1] + before([len(x) for x in lists])[1:]]))

    def first(self, n: int) -> Lists:
        return Lists(self.ids[: self.before[n]].copy(), self.before[: n + 1].copy())

    def joined(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the lists of these numbers, and how many stand before each of `bounds`."""
        start = self.before[numbers]
        count = self.before[numbers + 1] - start
        upto = before(count)
        return self.ids[np.repeat(start - upto[:-1], count) + np.arange(upto[-1])].astype(np.int64), upto[bounds]


def before(lengths) -> np.ndarray:
    """The sum before each entry, and that of all."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Pair:
    """Both tokenizers, opened once per worker process, with the ids of at most `cache_entries` words and a slice's."""

    def __init__(self, byte_level_json: str, piece_model: bytes, cache_entries: int):
        self.encoder = PretokenEncoder(byte_level_json, cache_entries, _pack, b"".join)
        # Special tokens' strings are plain text here, so no text needs the library for having one.
        self.encoder.special = []
        self.piece_model, self.cache_entries, self._live = piece_model, cache_entries, None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "lists")} | {"_live": None}

    def _ready(self):
        if self._live is None:
            import sentencepiece

            tokenizer = self.encoder.tokenizer()
            tokenizer.encode_special_tokens = True
            byte_of = {c: b for b, c in byte_characters().items()}
            entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
            # Added tokens are not spelled in bytes; no text gives them.
            spelled = [bytes(byte_of[c] for c in e) if all(c in byte_of for c in e) else b"" for e in entries]
            pieces = sentencepiece.SentencePieceProcessor(model_proto=self.piece_model)
            plain = []
            for i in range(pieces.get_piece_size()):
                piece = pieces.id_to_piece(i)
                plain.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
            labels = [(len(spelled), ","), (len(spelled), "|"), (len(plain), ","), (len(plain), ";")]
            labels = [np.array([f"{i}{mark}" for i in range(n)], dtype=object) for n, mark in labels]
            # But for runs of spaces, a piece holds one in front only: B merges nothing across single spaces.
            inner = [p for i in range(pieces.get_piece_size()) if "▁" in (p := pieces.id_to_piece(i))[1:]]
            self.apart = not any(p.strip("▁") for p in inner)
            # Words are numbered as they come; lists of ids stand under the same numbers.
            self.words = defaultdict()
            self.words.default_factory = self.words.__len__
            self.lists = [Lists(np.zeros(0, np.int32), np.zeros(1, np.int64))] * 2
            self._live = tokenizer, pieces, _Spelling(spelled), _Spelling(plain), labels
        return self._live

    def _words(self, text: str) -> list[str]:
        """The runs between single spaces, each behind its space, which both sides cut there; none where they may not."""
        if not self.apart or "  " in text or "▁" in text or text.endswith(" "):
            return []
        return self.encoder.chunks(text) or []

    def _ids(self, spaced: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A's ids of all texts and the number before each text, and B's; B puts the space in front itself."""
        pieces = self._ready()[1]
        found = [self._words(text) for text in spaced]
        held, sizes = len(self.words), np.array([len(words) for words in found], dtype=np.int64)
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=sizes.sum())
        new = list(islice(reversed(self.words), len(self.words) - held))[::-1]
        _, find, _, cache = self.encoder._ready()
        # A's parts of words, such as marks, come again more often than words do.
        lists = [np.frombuffer(b"".join(map(cache.__getitem__, find(word))), dtype=ID).tolist() for word in new]
        cache.trim(self.cache_entries)
        self.lists = [self.lists[0] + lists, self.lists[1] + pieces.encode([word[1:] for word in new], num_threads=1)]
        # Any other text is one list behind those of the words, the library's of the whole.
        odd = np.flatnonzero(sizes == 0)
        texts = [spaced[k] for k in odd]
        numbers = np.insert(numbers, before(sizes)[odd], len(self.words) + np.arange(len(odd)))
        bounds = before(np.maximum(sizes, 1))
        whole = [[np.frombuffer(x, dtype=ID).tolist() for x in self.encoder.values(texts)], pieces.encode([text[1:] for text in texts], num_threads=1)]
        out = [(known + more).joined(numbers, bounds) for known, more in zip(self.lists, whole)]
        if len(self.words) > self.cache_entries:  # those that came first, which are the frequent ones, stay
            most = self.cache_entries // 2
            for word in list(islice(reversed(self.words), len(self.words) - most)):
                del self.words[word]
            self.lists = [known.first(most) for known in self.lists]
        return out

    def encoded(self, texts: list[str]) -> tuple[Tokens, Tokens]:
        """Tokens of space + text by A, and of text, to which B puts a space itself, by B; none for texts that are
        empty or that either side spells otherwise."""
        _, _, spell_a, spell_b, _ = self._ready()
        spaced = [" " + text if text else "" for text in texts]
        bodies = [text.encode() for text in spaced]
        whole, bounds = np.frombuffer(b"".join(bodies), dtype=np.uint8), before([len(x) for x in bodies])
        (a_ids, a_before), (b_ids, b_before) = self._ids(spaced)
        right = spell_a.spells(a_ids, a_before, whole, bounds) & spell_b.spells(b_ids, b_before, whole, bounds)
        return spell_a.tokens(a_ids, a_before, right), spell_b.tokens(b_ids, b_before, right)

    @property
    def b_size(self) -> int:
        return self._ready()[1].get_piece_size()

    def labels(self) -> tuple[np.ndarray, ...]:
        """Every id in decimal with what follows it: A's inside and at the end of a group, and B's."""
        return self._ready()[4]


class _Spelling:
    """Bytes of every id."""

    def __init__(self, table: list[bytes]):
        self.data, self.length = np.frombuffer(b"".join(table), dtype=np.uint8), np.array([len(x) for x in table], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length

    def spells(self, ids: np.ndarray, at: np.ndarray, whole: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether the ids of each text, those from at[k] on, spell its bytes, those of `whole` from bounds[k] on."""
        upto = before(self.length[ids])
        right = upto[at[1:]] - upto[at[:-1]] == np.diff(bounds)
        # Texts of the right length are spelled out and compared byte by byte.
        ids, body = ids[np.repeat(right, np.diff(at))], whole[np.repeat(right, np.diff(bounds))]
        length = self.length[ids]
        spelled = self.data[np.repeat(self.start[ids] - before(length)[:-1], length) + np.arange(len(body))]
        wrong = np.flatnonzero(spelled != body)
        texts = np.flatnonzero(right)
        ends = np.cumsum(np.diff(bounds)[texts])
        right[texts[np.searchsorted(ends, wrong, side="right")]] = False
        return right

    def tokens(self, ids: np.ndarray, at: np.ndarray, right: np.ndarray) -> Tokens:
        """The tokens of the texts that are right; the others have none."""
        count = np.diff(at)
        ids = ids[np.repeat(right, count)]
        return Tokens(ids, self.length[ids], before(np.where(right, count, 0)))


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, total: int, stretch: int = STRETCH_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all pairs of equal values of two strictly ascending arrays of byte offsets up to `total`.

    All stretches of `stretch` bytes are merged in lockstep: at most as many steps as a stretch has tokens.
    """
    edges = np.arange(0, total + stretch, stretch)
    starts_a, starts_b = (np.searchsorted(ends, edges, side="right") for ends in (ends_a, ends_b))
    i, j, last_i, last_j = starts_a[:-1].copy(), starts_b[:-1].copy(), starts_a[1:], starts_b[1:]
    found_i, found_j = [], []
    while True:
        going = np.flatnonzero((i < last_i) & (j < last_j))
        if len(going) < len(i):  # stretches that are through leave the state
            i, j, last_i, last_j = i[going], j[going], last_i[going], last_j[going]
        if not len(i):
            break
        a, b = ends_a[i], ends_b[j]
        equal = np.flatnonzero(a == b)
        found_i.append(i[equal])
        found_j.append(j[equal])
        i, j = i + (a <= b), j + (b <= a)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_i, all_j = np.concatenate(found_i), np.concatenate(found_j)
    order = np.argsort(all_i)
    return all_i[order], all_j[order]


def group_texts(a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray, labels) -> list[str]:
    """Per text 'a1,a2|b1;a3|b2,b3': both sides' ids, group after group; cuts are the last tokens of groups."""
    inner_a, last_a, inner_b, last_b = labels
    # A token stands behind its side's earlier ones and the other side's tokens of all groups that come before it:
    # for B those of its own group too.
    group_a = np.searchsorted(cut_a, np.arange(len(a.ids)))
    group_b = np.searchsorted(cut_b, np.arange(len(b.ids)))
    b_before = np.concatenate([[0], cut_b + 1])
    a_through = cut_a + 1
    place_a = np.arange(len(a.ids)) + b_before[group_a]
    place_b = np.arange(len(b.ids)) + a_through[group_b]
    parts = np.empty(len(a.ids) + len(b.ids), dtype=object)
    parts[place_a], parts[place_b] = inner_a[a.ids], inner_b[b.ids]
    parts[place_a[cut_a]], parts[place_b[cut_b]] = last_a[a.ids[cut_a]], last_b[b.ids[cut_b]]
    bounds = a.before + b.before
    return ["".join(parts[first:last])[:-1] for first, last in zip(bounds[:-1], bounds[1:])]


def align_texts(pair: Pair, texts: list[str]) -> dict[str, pa.Array]:
    """Columns n_a ... times of ALIGNED_SCHEMA for a list of texts."""
    a, b = pair.encoded(texts)
    ends_a, ends_b = a.ends(), b.ends()
    total = int(ends_a[-1]) if len(ends_a) else 0
    # Texts lie one behind the other, and their ends are common ends: nothing is linked across texts.
    cut_a, cut_b = common_ends(ends_a, ends_b, total)
    text = np.searchsorted(a.before, cut_a, side="right") - 1
    groups = np.bincount(text, minlength=len(texts))
    digests = [
        hashlib.sha256(line.encode()).hexdigest() if line else "" for line in group_texts(a, b, cut_a, cut_b, pair.labels())
    ]
    key = a.ids[cut_a] * pair.b_size + b.ids[cut_b]
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate([at, [len(key)]]))
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[at], minlength=len(texts)))]), pa.int32())
    whole = {"n_a": np.diff(a.before), "n_b": np.diff(b.before), "n_groups": groups, "n_links": groups}
    return {name: pa.array(values, pa.int64()) for name, values in whole.items()} | {
        "groups_sha256": pa.array(digests, pa.string()),
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(key[at], pa.int64())),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
    }


def align_documents(docs: DataFrame, byte_level_path: str, piece_path: str, cache_entries: int = 400_000) -> DataFrame:
    """One row per row of `docs` (doc_id, text), in the columns of ALIGNED_SCHEMA.

    A is a byte-level vocabulary of the tokenizers library and gets a space before the text, B a sentencepiece model
    that adds one; both paths are read on the driver. Strings of special tokens are plain text. A and B tokens whose
    byte ranges end together are linked; those ends cut both sides into groups. `pairs` are the text's distinct links
    as A id times B's size plus B id, `times` how often each occurs. Null and empty texts, and texts whose tokens
    spell anything but space + text, have no tokens. Rows with null or repeated ids are aligned each on its own.
    Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(byte_level_path, encoding="utf-8") as spec, open(piece_path, "rb") as model:
        held = shared(docs.sparkSession, Pair(spec.read(), model.read(), cache_entries))

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = held()
        for batch in batches:
            for first, last in words.slices(batch.column("text")):
                texts = pc.fill_null(batch.column("text").slice(first, last - first), "").to_pylist()
                ids = batch.column("doc_id").slice(first, last - first)
                yield pa.RecordBatch.from_pydict({"doc_id": ids} | align_texts(pair, texts))

    return docs.mapInArrow(align, ALIGNED_SCHEMA)


def graded_pairs(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): links corpus-wide of every id pair, and whether no pair of its B id has more."""
    links = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = written(counts.withColumn("b", F.col("pair") % b_size), "pairs")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))  # a row per B id
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _frequent_from(graded: DataFrame, most: int) -> int:
    """The least count from which on at most `most` pairs have it: read off a histogram with eight bins a doubling."""
    bins = graded.groupBy(F.floor(F.log2("count") * 8).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("low"))
    held, low = 0, None
    for row in bins.orderBy(F.col("bin").desc()).collect():  # at most 8 * 63 rows
        held += row.n
        if held > most:
            break
        low = row.low
    return (1 << 62) if low is None else low


def link_scores(aligned: DataFrame, b_size: int, frequent_pairs: int = 1 << 17) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of align_documents' rows.

    n_best counts the links whose id pair is among the most frequent of its B id, count_sum adds up the pairs'
    counts. Counts are looked up in two tiers: the at most `frequent_pairs` most frequent pairs, which hold most
    links, are broadcast; only links of the rest are joined by a shuffle.
    """
    # A row is named where it is written; what follows starts from the files.
    aligned = written(aligned.withColumn("row_number", F.monotonically_increasing_id()), "aligned")
    graded = written(graded_pairs(aligned, b_size), "graded")
    low = _frequent_from(graded, frequent_pairs)
    frequent = F.broadcast(graded.where(F.col("count") >= low))
    rare = graded.where(F.col("count") < low)
    zipped = aligned.select("row_number", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    links = zipped.select("row_number", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = [
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    ]
    near = links.join(frequent, "pair").groupBy("row_number").agg(*sums)
    rest = links.join(frequent.select("pair"), "pair", "left_anti").join(rare, "pair").groupBy("row_number").agg(*sums)
    totals = near.unionByName(rest).groupBy("row_number").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    joined = aligned.drop("pairs", "times").join(totals, "row_number", "left")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
        "groups_sha256",
    )


def align_and_score(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """link_scores of align_documents."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    return link_scores(align_documents(docs, byte_level_path, piece_path), b_size)
