"""Connected components of a graph given as rows: contracted in bounded pieces, then by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.scratch import written

# Edges that a task contracts at a time.
TASK_EDGES = 1 << 18


def star_edges(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node that is not the smallest of its component to the one that is."""
    ids, code = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = code[: len(u)], code[len(u) :]
    label = np.arange(len(ids))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]
    below = np.flatnonzero(label != np.arange(len(ids)))
    return ids[below], ids[label[below]]


def _contractor(most: int):
    def contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def contracted() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            found = star_edges(table["u"].to_numpy(), table["v"].to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["u", "v"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > most:
                yield contracted()
                held, rows = [], 0
        if rows:
            yield contracted()

    return contract


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung below the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    low = written(low, "lows")  # read back, both sides of the join are dealt by Spark, which splits a hub's rows
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is hung below the smallest of them."""
    low = written(edges.groupBy("u").agg(F.min("v").alias("low")), "lows")
    rest = edges.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return rest.union(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    `edges` has two integer columns u and v without nulls; loops, repeats and both directions are
    allowed. Tasks first replace about `TASK_EDGES` edges at a time by stars, which settles a graph of that size; a larger
    one goes on in rounds whose number grows with the logarithm of the number of nodes. A node with very many neighbours
    needs one aggregate row per task and a join that adaptive execution can split.
    """
    u, v = F.col("u"), F.col("v")
    edges = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges = written(edges, "edges")
    tasks = -(-edges.count() // TASK_EDGES)
    if tasks:
        edges = written(edges.coalesce(tasks).mapInArrow(_contractor(TASK_EDGES), "u long, v long"), "edges")
    while tasks > 1:
        parents = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("own"))
        roots = edges.select("v").distinct()
        unsettled = parents.join(roots, parents.u == roots.v, "left").where("n > 1 or v is not null")
        if unsettled.limit(1).count() == 0:
            break
        edges = written(_small_star(_large_star(edges)), "edges")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
