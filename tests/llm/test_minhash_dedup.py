import random

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import components as graph
from cohortflow.llm.components import components
from cohortflow.llm.linking import linked
from cohortflow.llm.minhash_dedup import SET_SCHEMA, _collider, _confirmer, _set_maker, near_duplicates


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """Sorted (doc_id, n_shingles, component_id, kept)."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i):
            if a[0] is None or rows[j][0] is None:
                continue
            shared = len(sets[i] & sets[j])
            alike = sets[i] and sets[j] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared)
            if alike or a[0] == rows[j][0]:
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = None if r[0] is None else low[root(i)]
        out.append((r[0], len(sets[i]), c, c == r[0]))
    return sorted(out, key=str)


def result(docs, **more):
    found = near_duplicates(docs, **more).select("doc_id", "n_shingles", "component_id", "kept")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_awkward_rows(awkward, awkward_rows):
    assert result(awkward) == brute(awkward_rows)


def test_nothing(nothing):
    assert result(nothing) == []


def test_sample(sample, sample_rows):
    got = result(sample)
    assert got == brute([(r.doc_id, r.text) for r in sample_rows])
    assert any(not r[3] for r in got)


@pytest.mark.parametrize("blocks", [8, 1024])
def test_a_hot_group_of_near_copies_in_blocks(spark, blocks):
    rnd = random.Random(5)
    base = [f"t{rnd.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rnd.randrange(5)):
            words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
        rows.append((i * 7 % 71, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, list_rows=blocks, cluster_rows=blocks) == brute(rows)


def test_members_outside_the_largest_component_meet_all(spark):
    # Few pivots and small blocks: most links are found in the second pass only.
    rnd = random.Random(8)
    rows = []
    for i in range(120):
        base = [f"g{i % 30}x{k}" for k in range(60)]
        base[rnd.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = linked(
        docs.select(F.lit(1).cast("long").alias("cluster"), F.col("doc_id").alias("node"), F.lit(120).cast("long").alias("members")),
        lambda placed: docs.withColumnRenamed("doc_id", "node").join(placed, "node").mapInArrow(_set_maker(5), SET_SCHEMA),
        _confirmer(80),
        block_rows=8,
        pivots=1,
    )
    found = dict(tuple(r) for r in components(got).collect())
    assert {i: found.get(i, i) for i, _ in rows} == {r[0]: r[2] for r in brute(rows, 80)}


def test_rows_compared_grow_with_the_copies_not_with_their_square(spark):
    def rows_placed(n):
        tokens = [[k if k != i % 32 else 1000 + i for k in range(32)] for i in range(n)]
        reps = spark.createDataFrame(list(enumerate(tokens)), "node long, tokens array<bigint>")
        members = reps.select(F.lit(7).cast("long").alias("cluster"), "node", F.lit(n).cast("long").alias("members"))
        counts = []

        def attach(placed):
            counts.append(placed.select(F.explode("spots")).count())
            return placed.join(reps, "node")

        edges = linked(members, attach, _collider(32, 16), block_rows=32, pivots=4)
        assert {r.component for r in components(edges).collect()} == {0}
        return sum(counts)

    small, large = rows_placed(400), rows_placed(1600)
    assert large < 5 * small and large < 2 * 1600


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(129, 130), (130, 129), (130, 130)]
    edges = chain + star + [(500, 500)]
    random.Random(1).shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 131)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def shuffled_chains(spark):
    rng = random.Random(8)
    edges = [(100 * k + i, 100 * k + i + 1) for k in range(20) for i in range(99)]
    edges = [pair if rng.random() < 0.5 else pair[::-1] for pair in edges]
    rng.shuffle(edges)
    return spark.createDataFrame(edges, "u long, v long").repartition(7)


@pytest.mark.parametrize("task_edges", [1 << 18, 50])
def test_chains_are_contracted_in_pieces(spark, monkeypatch, task_edges):
    monkeypatch.setattr(graph, "TASK_EDGES", task_edges)
    got = sorted(tuple(r) for r in components(shuffled_chains(spark)).collect())
    assert got == [(i, i - i % 100) for i in range(2000)]


def test_a_small_graph_needs_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "_large_star", None)
    assert components(shuffled_chains(spark)).select("component").distinct().count() == 20
