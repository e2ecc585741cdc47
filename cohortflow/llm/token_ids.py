"""Token ids as binary shards with a minimal perfect hash index for keyed access.

A shard file holds, in this order:

* payload: the ids of its documents, one after another, as little-endian unsigned 16- or 32-bit integers;
* documents: in payload order, doc_id, whether it is null, its copy number among equal ids, first id;
* seeds: one displacement per hash bucket, and slots: per hash slot a fingerprint and a document number;
* footer: sizes of the above.

A key (doc_id, copy) is hashed to a bucket, the bucket's displacement gives the slot, the slot's fingerprint
tells whether the key is there: a fixed number of small reads, whatever the shard's size.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm import blobs, words
from cohortflow.llm.pretokens import PretokenEncoder
from cohortflow.llm.scratch import new_folder, written
from cohortflow.llm.shared import shared

DOCUMENT = np.dtype([("doc_id", "<i8"), ("copy", "<u4"), ("is_null", "<u4"), ("first", "<u8")])
SLOT = np.dtype([("fingerprint", "<u4"), ("document", "<u4")])
FOOTER = np.dtype(
    [("magic", "S8"), ("width", "<u4"), ("spare", "<u4"), ("ids", "<u8"), ("documents", "<u8"), ("buckets", "<u8")]
)
MAGIC = b"tokids01"
KEYS_PER_BUCKET = 2
FILE_SCHEMA = "part int, piece int, uri string, documents long, ids long, low long, high long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, copy int, shard int"


# -- the index ------------------------------------------------------------------------------------


def key_hashes(documents: np.ndarray) -> np.ndarray:
    """64-bit hashes of the keys (doc_id or null, copy)."""
    tag = documents["copy"].astype(np.uint64) * np.uint64(2) + documents["is_null"].astype(np.uint64)
    return words.mix(words.mix(documents["doc_id"].astype(np.int64).view(np.uint64)) ^ tag)


def _slot(keys: np.ndarray, seed: np.ndarray | int, slots: int) -> np.ndarray:
    return words.mix(keys ^ words.mix(np.atleast_1d(np.asarray(seed, dtype=np.uint64)))) % np.uint64(slots)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed per bucket, slot of each key) with every one of len(keys) slots used once.

    Buckets of several keys search a displacement, largest first; a bucket of one key takes a free slot,
    stored as -1 - slot.
    """
    n = len(keys)
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    seeds, slot_of = np.zeros(buckets, dtype=np.int64), np.zeros(n, dtype=np.int64)
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    used = np.zeros(n, dtype=bool)
    several = np.argsort(-sizes, kind="stable")
    for b in several[: int((sizes > 1).sum())]:
        members = order[starts[b] : starts[b + 1]]
        mine, tried, width = keys[members], 0, 16
        while True:
            seed_block = np.arange(tried, tried + width, dtype=np.uint64)
            options = (words.mix(mine ^ words.mix(seed_block)[:, None]) % np.uint64(n)).astype(np.int64)
            apart = (np.diff(np.sort(options, axis=1), axis=1) > 0).all(axis=1)
            fits = np.flatnonzero(apart & ~used[options].any(axis=1))
            if len(fits):
                seed, places = tried + int(fits[0]), options[fits[0]]
                break
            tried, width = tried + width, min(2 * width, 1024)
        used[places] = True
        seeds[b], slot_of[members] = seed, places
    alone = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~used)
    seeds[alone], slot_of[order[starts[alone]]] = -1 - free, free
    return seeds, slot_of


def slots_of(keys: np.ndarray, seeds: np.ndarray, slots: int) -> np.ndarray:
    """The slot each key would have."""
    seed = seeds[(keys % np.uint64(len(seeds))).astype(np.int64)]
    return np.where(seed < 0, -1 - seed, _slot(keys, np.maximum(seed, 0).astype(np.uint64), slots).astype(np.int64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (words.mix(keys ^ np.uint64(0x5BF03635)) >> np.uint64(32)).astype(np.uint32)


# -- writing --------------------------------------------------------------------------------------


class _OpenShard:
    """A shard file being written; what it holds in memory is bounded by `full`."""

    def __init__(self, folder: str, name: str, width: int, end_id: int):
        self.out, self.width, self.documents, self.total, self.n = blobs.Writer(folder, name), width, [], 0, 0
        self.end = np.array([end_id], dtype="<u2" if width == 2 else "<u4").tobytes()
        self.low = self.high = None

    def full(self, most_bytes: int, most_documents: int) -> bool:
        return self.total * self.width >= most_bytes or self.n >= most_documents

    def add(self, ids: list[int | None], copies: list[int], payloads: list[bytes]) -> None:
        table = np.zeros(len(ids), dtype=DOCUMENT)
        for i, (doc_id, copy, payload) in enumerate(zip(ids, copies, payloads)):
            table[i] = (doc_id or 0, copy, doc_id is None, self.total)
            self.total += len(payload) // self.width + 1
        known = [doc_id for doc_id in ids if doc_id is not None]
        if known:
            self.low = known[0] if self.low is None else self.low
            self.high = known[-1]
        self.documents.append(table)
        self.n += len(table)
        self.out.write(self.end.join([*payloads, b""]))

    def finish(self, part: int, piece: int) -> pa.RecordBatch:
        table = np.concatenate(self.documents)
        keys = key_hashes(table)
        seeds, slot_of = build_index(keys)
        slots = np.zeros(len(table), dtype=SLOT)
        slots["fingerprint"][slot_of] = fingerprints(keys)
        slots["document"][slot_of] = np.arange(len(table))
        for block in (table, seeds.astype("<i8"), slots):
            self.out.write(block.tobytes())
        footer = (MAGIC, self.width, 0, self.total, len(table), len(seeds))
        self.out.write(np.array([footer], dtype=FOOTER).tobytes())
        self.out.close()
        values = [part, piece, self.out.uri, len(table), self.total, self.low, self.high]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["part", "piece", "uri", "documents", "ids", "low", "high"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


def _write_shards(held, folder: str, end_id: int, width: int, most_bytes: int, most_documents: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, piece, shard = held(), TaskContext.get().partitionId(), 0, None
        last, copy = write, 0  # no id equals the function
        for batch in batches:
            for first, stop in words.slices(batch.column("text")):
                ids = batch.column("doc_id").slice(first, stop - first).to_pylist()
                texts = pc.fill_null(batch.column("text").slice(first, stop - first), "").to_pylist()
                copies = []
                for doc_id in ids:
                    copy = copy + 1 if doc_id == last else 0
                    last = doc_id
                    copies.append(copy)
                shard = shard or _OpenShard(folder, f"shard-{part:06d}-{piece:04d}", width, end_id)
                shard.add(ids, copies, encoder.values(texts))
                if shard.full(most_bytes, most_documents):
                    yield shard.finish(part, piece)
                    shard, piece = None, piece + 1
        if shard is not None:
            yield shard.finish(part, piece)

    return write


def id_width(spec: str, end_id: int) -> int:
    """Bytes for any id of a vocabulary: 2 or 4."""
    from tokenizers import Tokenizer

    top = max(Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True) - 1, end_id)
    return 2 if top < 1 << 16 else 4


def write_token_ids(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    shards: int | None = None,
    cache_entries: int = 400_000,
    folder: str | None = None,
    shard_bytes: int = 1 << 28,
    shard_documents: int = 1 << 20,
) -> DataFrame:
    """Encode every text, append `end_id`, write shards in ascending doc_id order; returns the manifest.

    Manifest: shard, uri, documents, ids, start (ids before the shard), and the lowest and highest doc_id. A null
    text counts as empty; null ids come first; rows with equal ids are told apart by a copy number, in the order of
    a hash of the text, then the text, and may lie in several shards. No rows: no shard. Other columns of `docs` are
    ignored. Files go below `folder`, by default a new one in the session's shared folder.

    Rows are dealt by ranges of doc_id into `shards` tasks, by default as many as the session's shuffles have. A
    task begins a new shard once one holds `shard_bytes` of ids or `shard_documents` documents, so that neither the
    index of a shard nor what a task holds grows with the input.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    width = id_width(spec, end_id)
    code = "H" if width == 2 else "I"
    held = shared(spark, PretokenEncoder(spec, cache_entries, lambda ids: struct.pack(f"<{len(ids)}{code}", *ids), b"".join))
    dealt = docs.repartitionByRange(shards, "doc_id") if shards else docs.repartitionByRange("doc_id")
    # Ties go by text, so that reruns agree; the hash settles nearly all of them.
    dealt = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    folder = folder or new_folder(spark, "token-ids")
    write = _write_shards(held, folder, end_id, width, shard_bytes, shard_documents)
    files = written(dealt.mapInArrow(write, FILE_SCHEMA), "manifest")
    order = Window.orderBy("part", "piece")  # one row per shard
    before = F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1))
    shard, start = (F.row_number().over(order) - 1).alias("shard"), F.coalesce(before, F.lit(0)).alias("start")
    return files.select(shard, "uri", "documents", "ids", start, "low", "high")


# -- reading --------------------------------------------------------------------------------------


class Shard:
    """Keyed and sequential access to one shard file."""

    def __init__(self, uri: str):
        self.file = blobs.reader(uri)
        size = self.file.size()
        self.footer = np.frombuffer(self._read(FOOTER.itemsize, size - FOOTER.itemsize), dtype=FOOTER)[0]
        if self.footer["magic"] != MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        self.width, self.ids = int(self.footer["width"]), int(self.footer["ids"])
        self.n, self.buckets = int(self.footer["documents"]), int(self.footer["buckets"])
        self.documents_at = self.ids * self.width
        self.seeds_at = self.documents_at + self.n * DOCUMENT.itemsize
        self.slots_at = self.seeds_at + self.buckets * 8

    def _read(self, size: int, at: int) -> bytes:
        return self.file.read_at(size, at)

    def close(self) -> None:
        self.file.close()

    def documents(self) -> np.ndarray:
        return np.frombuffer(self._read(self.n * DOCUMENT.itemsize, self.documents_at), dtype=DOCUMENT)

    def index(self) -> tuple[np.ndarray, np.ndarray]:
        seeds = np.frombuffer(self._read(self.buckets * 8, self.seeds_at), dtype="<i8")
        return seeds, np.frombuffer(self._read(self.n * SLOT.itemsize, self.slots_at), dtype=SLOT)

    def payload(self, first: int, last: int) -> np.ndarray:
        kind = "<u2" if self.width == 2 else "<u4"
        return np.frombuffer(self._read((last - first) * self.width, first * self.width), dtype=kind)

    def find(self, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
        """The ids of one document, or None: four reads besides the payload."""
        key = key_hashes(np.array([(doc_id or 0, copy, doc_id is None, 0)], dtype=DOCUMENT))
        bucket = int(key[0] % np.uint64(self.buckets))
        seed = np.frombuffer(self._read(8, self.seeds_at + 8 * bucket), dtype="<i8")
        place = int(np.where(seed < 0, -1 - seed, _slot(key, np.maximum(seed, 0), self.n).astype(np.int64))[0])
        slot = np.frombuffer(self._read(SLOT.itemsize, self.slots_at + place * SLOT.itemsize), dtype=SLOT)[0]
        if slot["fingerprint"] != fingerprints(key)[0]:
            return None
        number = int(slot["document"])
        more = 1 if number == self.n - 1 else 2
        found = np.frombuffer(
            self._read(more * DOCUMENT.itemsize, self.documents_at + number * DOCUMENT.itemsize), dtype=DOCUMENT
        )
        same = found[0]["doc_id"] == (doc_id or 0) and found[0]["is_null"] == (doc_id is None)
        if not same or found[0]["copy"] != copy:
            return None
        return self.payload(int(found[0]["first"]), int(found[1]["first"]) if more == 2 else self.ids)


def find(manifest: list, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """The ids of one document, given the rows of a manifest; None where no shard has it."""
    rows = sorted(manifest, key=lambda r: r.shard)
    known = [r for r in rows if r.low is not None]
    if doc_id is None:
        able = rows[: len(rows) - len(known) + 1]  # null ids come first; the first shard with others may begin with them
    else:
        able = takewhile(lambda r: r.low <= doc_id, known[bisect_left([r.high for r in known], doc_id) :])
    for row in able:
        shard = Shard(row.uri)
        try:
            ids = shard.find(doc_id, copy)
        finally:
            shard.close()
        if ids is not None:
            return ids
    return None


def _crc(parts: Iterable[np.ndarray]) -> int:
    total = 0
    for part in parts:
        total = zlib.crc32(part.astype("<u4").tobytes(), total)
    return total


def _read_shards(batches: Iterable[pa.RecordBatch], window: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, uri, base in zip(*(batch.column(c).to_pylist() for c in ("shard", "uri", "start"))):
            shard = Shard(uri)
            table = shard.documents()
            seeds, slots = shard.index()
            keys = key_hashes(table)
            found = slots[slots_of(keys, seeds, shard.n)]
            if (found["fingerprint"] != fingerprints(keys)).any():
                raise ValueError(f"index and documents disagree: {uri}")
            place = found["document"].astype(np.int64)
            bounds = np.append(table["first"], shard.ids).astype(np.int64)
            low, high = bounds[place], bounds[place + 1]
            crcs, at, held = np.zeros(len(table), dtype=np.int64), 0, np.zeros(0, dtype=np.uint16)
            for i, (first, last) in enumerate(zip(low.tolist(), high.tolist())):
                if last - first > window:
                    cuts = range(first, last, window)
                    crcs[i] = _crc(shard.payload(c, min(c + window, last)) for c in cuts)
                    continue
                if first < at or last > at + len(held):
                    at, held = first, shard.payload(first, min(first + window, shard.ids))
                crcs[i] = _crc([held[first - at : last - at]])
            shard.close()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table["doc_id"].astype(np.int64), mask=table["is_null"].astype(bool)),
                    pa.array(base + low), pa.array(high - low), pa.array(crcs),
                    pa.array(table["copy"].astype(np.int32)),
                    pa.array(np.full(len(table), number, dtype=np.int32)),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "copy", "shard"],
            )


def read_token_ids(manifest: DataFrame) -> DataFrame:
    """Per document of the shards: doc_id, start (ids before it in all shards), n_tokens, ids_crc32, copy, shard.

    ids_crc32 is the unsigned CRC-32 of its ids as little-endian unsigned 32-bit integers. Documents are found
    through the index; a long one is read in windows.
    """
    spark: SparkSession = manifest.sparkSession
    files = max(1, manifest.count())
    parts = min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    return manifest.select("shard", "uri", "start").repartition(parts).mapInArrow(_read_shards, READ_SCHEMA)
