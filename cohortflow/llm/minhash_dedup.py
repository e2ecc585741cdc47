"""Near-duplicate documents by MinHash, with a signature-coordinate inverted join.

A document's MinHash signature has one value per coordinate. Documents are posted under each
(coordinate, value) pair; two documents with at least `matches` equal coordinates are candidates.
Counting collisions does not need every list:

* prefix: with pairs ordered by how many documents share them, two candidates must meet among the
  `coordinates - matches + 1` rarest pairs of each, so only those are posted, and a pair that only
  one document has needs no list;
* skip: a list that holds the same documents as another is merged once.

Lists longer than a block are merged in bounded blocks that share a few pivots; only members left
outside a list's largest component meet the others again, so that no pair is missed. A block hands on a
spanning forest of its candidates, not the pairs, so rows stay linear in the postings. Clusters of
candidates are then compared on full shingle sets in the same way, and the confirmed links give the
components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm import groups, words
from cohortflow.llm.components import components
from cohortflow.llm.linking import linked
from cohortflow.llm.scratch import written
from cohortflow.operators.difference import among

SIGNATURE_SCHEMA = "doc_id long, n_shingles long, set_a long, set_b long, tokens array<bigint>"
SET_SCHEMA = "node long, cluster long, spots array<struct<low:int,high:int>>, hashes binary"


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, sorted distinct shingle hashes, hashes before each text) of row ranges."""
    for first, last in words.slices(column):
        hashed, before = words.word_hashes(column.slice(first, last - first), lower=True)
        runs, runs_before = words.shingle_hashes(hashed, before, size)
        for a, b in zip(runs_before[:-1], runs_before[1:]):
            runs[a:b].sort()
        new = np.ones(len(runs), dtype=bool)
        new[1:] = runs[1:] != runs[:-1]
        starts = runs_before[:-1]
        new[starts[starts < len(runs)]] = True
        yield first, last, runs[new], np.concatenate([[0], np.cumsum(new)])[runs_before]


def _signer(size: int, coordinates: int, seed: int) -> Callable:
    rng = np.random.default_rng(seed)
    flip, times = rng.integers(0, 1 << 63, (2, coordinates), dtype=np.uint64)
    times = times * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for first, last, sets, before in shingle_sets(text, size):
                rows = last - first
                n = np.diff(before)
                full = np.flatnonzero(n)
                tokens = np.zeros((len(full), coordinates), dtype=np.uint64)
                set_a, set_b = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                if len(full):
                    starts = before[:-1][full]
                    set_a[full] = np.add.reduceat(words.mix(sets ^ flip[0]), starts)
                    set_b[full] = np.bitwise_xor.reduceat(words.mix(sets ^ flip[-1]), starts)
                    for k in range(coordinates):
                        tokens[:, k] = np.minimum.reduceat((sets ^ flip[k]) * times[k], starts)
                    tokens = words.mix(tokens ^ (np.arange(coordinates, dtype=np.uint64) << np.uint64(52)))
                ends = np.zeros(rows + 1, dtype=np.int32)
                ends[1:] = np.cumsum((n > 0) * coordinates)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, rows), pa.array(n), pa.array(set_a.view(np.int64)),
                     pa.array(set_b.view(np.int64)), lists],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "tokens"],
                )

    return sign


def _pairs(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = groups.forest(linked)
    below = np.flatnonzero(label != np.arange(len(label)))
    return ids[below], ids[label[below]]


def _edges(found: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Edge batches of a useful size."""
    us, vs, rows = [], [], 0
    for u, v in found:
        if len(u):
            us.append(u)
            vs.append(v)
            rows += len(u)
        if rows >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
            us, vs, rows = [], [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])


def _collider(coordinates: int, matches: int, step: int = 8) -> Callable:
    def merge(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        ids = run.column("node").to_numpy()
        lists = run.column("tokens")
        tokens = lists.flatten().to_numpy().reshape(len(ids), coordinates)
        linked = np.zeros((len(ids), len(ids)), dtype=bool)
        for i in range(len(ids) - 1):
            rest = np.arange(i + 1, len(ids))
            count = np.zeros(len(rest), dtype=np.int64)
            for k in range(0, coordinates, step):
                count += (tokens[rest, k : k + step] == tokens[i, k : k + step]).sum(axis=1)
                left = max(0, coordinates - k - step)
                able = count + left >= matches  # the others cannot reach the threshold any more
                if not able.all():
                    rest, count = rest[able], count[able]
                if not len(rest):
                    break
            linked[i, rest] = linked[rest, i] = True
        return _pairs(ids, linked)

    def collide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edges(merge(run) for run in groups.runs(batches, ["cluster", "low", "high"]))

    return collide


def _set_maker(size: int) -> Callable:
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, sets, before in shingle_sets(batch.column("text"), size):
                blobs = [sets[a:b].tobytes() for a, b in zip(before[:-1], before[1:])]
                kept = [batch.column(c).slice(first, last - first) for c in ("node", "cluster", "spots")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(blobs, type=pa.binary())], names=["node", "cluster", "spots", "hashes"]
                )

    return make


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of a bounded list of sets."""
    if len(sets) == 2:
        both = np.concatenate(sets)
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]])
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    common = count[code] > 1
    member, code = member[common], number[code[common]]
    order = np.argsort(code, kind="stable")
    member, code = member[order], code[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, [low, low + columns])
        dense = np.zeros((len(sets), columns), dtype=np.float32)
        dense[member[a:b], code[a:b] - low] = 1
        total += dense @ dense.T
    return total.round().astype(np.int64)


def _confirmer(percent: int) -> Callable:
    def confirm_run(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        ids = run.column("node").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in run.column("hashes").to_pylist()]
        if len(ids) < 2:
            return ids[:0], ids[:0]
        sizes = np.array([len(s) for s in sets])
        shared = intersections(sets)
        linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
        np.fill_diagonal(linked, False)
        return _pairs(ids, linked)

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edges(confirm_run(run) for run in groups.runs(batches, ["cluster", "low", "high"]))

    return confirm


def candidate_edges(reps: DataFrame, coordinates: int, matches: int, block_rows: int) -> DataFrame:
    """A spanning forest (u, v) of the pairs of `reps` (rep, tokens) with enough equal coordinates."""
    posted = reps.select("rep", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("documents")).where("documents > 1")
    posted = posted.join(shared, "token")
    # Pairs that one document has alone are the rarest and never meet: they only shorten the prefix.
    mine = Window.partitionBy("rep")
    posted = (
        posted.withColumn("place", F.row_number().over(mine.orderBy("documents", "token")))
        .withColumn("met", F.count(F.lit(1)).over(mine))
        .where(F.col("place") <= F.col("met") - matches + 1)
        .select("rep", "token")
    )
    posted = written(posted, "postings")
    lists = (
        posted.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.bit_xor(F.xxhash64("rep")).alias("a"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("b"),
        )
        .where("members > 1")
        .groupBy("members", "a", "b")
        .agg(F.min("token").alias("token"))
        .select("token", "members")
    )
    members = posted.join(lists, "token").select(F.col("token").alias("cluster"), F.col("rep").alias("node"), "members")
    signatures = reps.withColumnRenamed("rep", "node")
    return linked(members, lambda placed: placed.join(signatures, "node"), _collider(coordinates, matches), block_rows)


def confirmed_edges(docs: DataFrame, clusters: DataFrame, size: int, percent: int, block_rows: int) -> DataFrame:
    """A spanning forest (u, v) of the linked pairs inside each cluster (node, component)."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = clusters.join(sizes, "component").select(F.col("component").alias("cluster"), "node", "members")
    # Most documents stand in no cluster: their texts stay where they are, in all but few cases.
    hashed = F.xxhash64("node").alias("h")
    texts = docs.select(F.col("doc_id").alias("node"), "text").where("node is not null").select("*", hashed)
    texts = among(texts, clusters.select(hashed), clusters.count(), "h").drop("h")

    def with_sets(placed: DataFrame) -> DataFrame:
        # A merge join at every size: clusters grow with the input, so no plan may count on broadcasting them.
        return texts.join(placed.hint("merge"), "node").mapInArrow(_set_maker(size), SET_SCHEMA)

    return linked(members, with_sets, _confirmer(percent), block_rows)


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = 5,
    percent: int = 85,
    coordinates: int = 32,
    matches: int = 16,
    list_rows: int = 1024,
    cluster_rows: int = 256,
    seed: int = 11,
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| on their sets of `shingle_words`-word
    shingles of lower-cased (A-Z) words; component_id is the smallest doc_id reachable over links and kept
    marks that document. A text of fewer words has its whole sequence as its one shingle. Null and empty
    texts have no shingles and no links. Equal sets are one member, so copies are never paired. A null
    doc_id has no links: its component_id is null and it is kept. Rows that share a doc_id are one
    document whose links are those of any of its texts. Other columns of `docs` are ignored.

    With 32 coordinates, a pair at exactly 85 % has fewer than 16 equal ones, and is lost, with
    probability 5e-7; pairs more alike, far less. Two texts with different sets that agree on a 128-bit
    digest would be taken as copies. Lists longer than `list_rows` and clusters larger than `cluster_rows` are
    compared in blocks of about that size; see linking.py.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(docs.mapInArrow(_signer(shingle_words, coordinates, seed), SIGNATURE_SCHEMA), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    own = usable.join(classes, ["set_a", "set_b", "n_shingles"]).where("doc_id = rep")
    reps = written(own.dropDuplicates(["rep", "set_a", "set_b"]).select("rep", "tokens"), "reps")
    clusters = components(candidate_edges(reps, coordinates, matches, list_rows))
    links = confirmed_edges(docs, clusters, shingle_words, percent, cluster_rows)
    # Texts under one doc_id belong together whatever they hold.
    same = usable.join(classes, ["set_a", "set_b", "n_shingles"]).where("doc_id != rep")
    many = usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = same.join(many, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = components(links.union(same))
    out = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(
        classes, ["set_a", "set_b", "n_shingles"], "left"
    )
    out = out.join(found, F.coalesce("rep", "doc_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("component", "rep", "doc_id"), "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
