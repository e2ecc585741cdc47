"""Connecting the members of groups of any size by comparing bounded blocks.

Only connected components are wanted, so members that are connected already need not meet again. A large
group is compared in two passes:

* its members are dealt into blocks, and a few of them, the pivots, stand in every block. Copies of one text
  mostly hang together after that;
* the largest component is set against the members outside it: those meet one another and every member of
  that component, in pairs of blocks. Two members that never meet are therefore connected already.

The result is exact. Rows grow with the group's size in the first pass, and in the second with the number of
members outside the largest component times the number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm import groups
from cohortflow.llm.components import components
from cohortflow.llm.scratch import written

PIVOTS = 16


def _blocks(size: Column, block_rows: int) -> Column:
    return F.ceil(size / F.lit(block_rows)).cast("int")


def _own(blocks: Column, block_rows: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(block_rows)), blocks.cast("bigint")).cast("int")


def first_spots(members: DataFrame, block_rows: int, pivots: int = PIVOTS) -> DataFrame:
    """cluster, node and the (low, high) blocks of the first pass: one block, or all of them for about `pivots` members."""
    size = F.col("members")
    blocks = _blocks(size, block_rows)
    chosen = F.pmod(F.xxhash64("node", "cluster", F.lit(1)), size) < pivots
    spots = F.when(chosen, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(_own(blocks, block_rows)))
    spots = F.transform(spots, lambda block: F.struct(block.alias("low"), block.alias("high")))
    return members.select("cluster", "node", spots.alias("spots"))


def later_spots(members: DataFrame, found: DataFrame, block_rows: int) -> DataFrame:
    """cluster, node and the (low, high) blocks of the second pass; members of connected groups have none.

    `found` (node, component) is what the first pass connected.
    """
    named = members.join(found, "node", "left").select(
        "cluster", "node", F.coalesce("component", "node").alias("component")
    )
    parts = named.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    most = parts.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n"))
    most = most.where("n > top.n").select(
        "cluster", F.col("top.component").alias("main"),
        _blocks(F.col("top.n"), block_rows).alias("inside"), _blocks(F.expr("n - top.n"), block_rows).alias("outside"),
    )
    named = named.join(most, "cluster")
    inside, outside = F.col("inside"), F.col("outside")
    among = F.sequence(F.lit(0), outside - 1)
    own = _own(F.when(F.col("component") == F.col("main"), inside).otherwise(outside), block_rows)
    # Blocks of the main component are numbered after the others.
    main = F.transform(among, lambda other: F.struct(other.alias("low"), (outside + own).alias("high")))
    rest = F.concat(
        F.transform(among, lambda o: F.struct(F.least(own, o).alias("low"), F.greatest(own, o).alias("high"))),
        F.transform(
            F.sequence(F.lit(0), inside - 1), lambda o: F.struct(own.alias("low"), (outside + o).alias("high"))
        ),
    )
    spots = F.when(F.col("component") == F.col("main"), main).otherwise(rest)
    return named.select("cluster", "node", spots.alias("spots"))


def linked(
    members: DataFrame, attach: Callable[[DataFrame], DataFrame], link: Callable, block_rows: int, pivots: int = PIVOTS
) -> DataFrame:
    """Edges (u, v) that connect what `link` finds in any group: the components are those of all links.

    `members` has cluster, node (long, without nulls) and members, the cluster's size. `attach` adds what is
    compared to rows of cluster, node and spots; `link` is a mapInArrow function that makes edges of runs of
    rows with equal cluster, low and high. No members: no edges.
    """

    def compared(placed: DataFrame) -> DataFrame:
        rows = attach(placed)
        rows = rows.withColumn("spot", F.explode("spots")).select(
            "cluster", "spot.low", "spot.high", *[name for name in rows.columns if name not in ("cluster", "spots")]
        )
        return groups.dealt(rows, ["cluster", "low", "high"]).mapInArrow(link, "u long, v long").distinct()

    edges = written(compared(first_spots(members, block_rows, pivots)), "links")
    large = written(members.where(F.col("members") > block_rows), "large")
    if large.limit(1).count() == 0:
        return edges
    return edges.union(compared(later_spots(large, components(edges), block_rows)))
