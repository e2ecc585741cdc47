"""Merkle trees over the rows of a table, grouped by language, by lag and lead windows.

Nodes of a group are numbered from 0. A window never spans a group: it spans a block of `2 ** levels` consecutive
nodes, inside which `levels` levels of the tree are built, level l with the fixed offset 2 ** l. The roots of the
blocks are the nodes of the next round, so a group of any size is split over tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.scratch import written

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
# Marks before a sibling's digest: on which side of the node it stands. A node alone has the empty text.
LEFT, RIGHT = "l", "r"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts' UTF-8, one after another."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row's columns, some of them replaced."""
    return digest(*[framed(changed.get(name, F.col(name))) for name in COLUMNS])


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes (grp, ...) with pos, the place within the group by `order`, and n, the group's size.

    Groups are cut by range into parts of near equal size, also inside one group and inside one value, since the
    last thing ordered by is a number of the row's own. A part is one window; the parts' sizes are one row each.
    """
    nodes = written(nodes.withColumn("row_number", F.monotonically_increasing_id()), "leaves")
    keys = ["grp", *order, "row_number"]
    parts = nodes.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    parts = written(parts, "parts")
    sizes = parts.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("grp").alias("s_grp"),
        F.col("part").alias("s_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(Window.partitionBy("grp")).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order, "row_number")) - 1
    placed = parts.withColumn("inside", inside)
    joined = placed.join(starts, (placed.grp == starts.s_grp) & (placed.part == starts.s_part))
    return joined.withColumn("pos", F.col("start") + F.col("inside")).drop(
        "inside", "start", "s_grp", "s_part", "part", "row_number"
    )


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """nodes (grp, pos, n, hash) with `path`, the siblings up to the block's root, and `root`, that root's digest.

    On level l only the rows of first leaves carry a node's digest; siblings stand 2 ** l rows before or after.
    Going down again, a node takes its parent's path from its own row or the one 2 ** l before.
    """
    size = 1 << levels
    window = Window.partitionBy("grp", "block").orderBy("pos")
    pos, n = F.col("pos"), F.col("n")
    tree = nodes.withColumn("block", F.shiftright("pos", levels)).withColumn("h0", F.col("hash"))
    for level in range(levels):
        step = 1 << level
        first, second = pos % (2 * step) == 0, pos % (2 * step) == step
        grows = n > step  # several nodes are left on this level
        right = F.lead(f"h{level}", step).over(window)
        left = F.lag(f"h{level}", step).over(window)
        tree = tree.withColumns({"next": right, "previous": left})
        has_right = grows & first & (pos + step < n)
        tree = tree.withColumns(
            {
                f"s{level}": F.when(grows & second, F.concat(F.lit(LEFT), "previous"))
                .when(has_right, F.concat(F.lit(RIGHT), "next"))
                .when(grows & first, F.lit("")),
                f"h{level + 1}": F.when(has_right, digest(F.col(f"h{level}"), F.col("next")))
                .when(grows & first, digest(F.col(f"h{level}")))
                .when(first, F.col(f"h{level}")),
            }
        ).drop("next", "previous", f"h{level}")
    tree = tree.withColumn("path", F.when(pos % size == 0, F.array().cast("array<string>")))
    for level in reversed(range(levels)):
        step = 1 << level
        tree = tree.withColumn("above", F.lag("path", step).over(window))
        up = F.when(pos % (2 * step) == step, F.col("above")).otherwise(F.col("path"))
        here = F.when(F.col(f"s{level}").isNull(), up).otherwise(F.concat(F.array(f"s{level}"), up))
        tree = tree.withColumn("path", F.when(pos % step == 0, here)).drop("above", f"s{level}")
    return tree.withColumnRenamed(f"h{levels}", "root").drop("hash")


def merkle_paths(nodes: DataFrame, levels: int = 8) -> tuple[DataFrame, DataFrame]:
    """Of nodes (grp, pos, n, hash, ...), numbered from 0 to n - 1 within each group: the nodes without `hash` but
    with `path`, and the groups' roots (grp, root).

    Consecutive pairs become the digest of both digests' hex text, a last single one of its own, until one is
    left. `path` lists a node's siblings from itself to the root: 'l' or 'r', its side, and its digest, or '' where
    a node had none. Neither grp nor pos may be null.
    """
    rounds, now = [], nodes
    while True:
        done = written(_blocks(now, levels), "merkle")
        rounds.append(done)
        roots = done.where(F.col("pos") % (1 << levels) == 0)
        upper = F.shiftright(F.col("n") + ((1 << levels) - 1), levels).alias("n")
        now = roots.select("grp", F.col("block").alias("pos"), upper, F.col("root").alias("hash"))
        if now.where("n > 1").isEmpty():
            break
    roots = now.select("grp", F.col("hash").alias("root"))

    def lengthened(upper: DataFrame, lower: DataFrame) -> DataFrame:
        above = upper.select(F.col("grp").alias("a_grp"), F.col("pos").alias("a_pos"), F.col("path").alias("a_path"))
        both = lower.join(above, (lower.grp == above.a_grp) & (lower.block == above.a_pos))
        return both.withColumn("path", F.concat("path", "a_path")).drop("a_grp", "a_pos", "a_path")

    return reduce(lengthened, reversed(rounds)).drop("block", "root"), roots


def proof_of(path: Column) -> Column:
    """The digest of all siblings on a path."""
    return digest(F.array_join(F.transform(path, lambda s: F.substr(s, F.lit(2))), ""))


def folded(path: Column, start: Column) -> Column:
    """The root that a leaf's digest gives together with the siblings on its path."""

    def up(node: Column, sibling: Column) -> Column:
        other = F.substr(sibling, F.lit(2))
        return F.when(sibling.startswith(LEFT), digest(other, node)).otherwise(digest(node, other))

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, levels: int = 8) -> DataFrame:
    """Per row of `docs` (doc_id, source, lang, n_chars, text): its leaf, its language's subroot, the root, and
    `path`, its siblings up to the root (see merkle_paths). `tampered` is the leaf after a change of n_chars.

    Languages are ordered by UTF-8 bytes, null first, and are the leaves of the upper tree. Rows without doc_id come
    first in their language; rows that share an id go by leaf; equal rows have neighbouring places in any order,
    so their proofs differ, but the rows of the result are the same on every run. The change adds 1 to n_chars where
    7 divides the CRC-32 of the decimal doc_id; rows without id or n_chars stay as they are. An empty table has an
    empty manifest. Other columns are ignored.
    """
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # Null goes before every language, also before the empty text.
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    leaves = docs.select(*COLUMNS).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        grp.alias("grp"),
        leaf().alias("hash"),
        F.when(changes & F.col("n_chars").isNotNull(), leaf(n_chars=F.col("n_chars") + 1)).alias("tampered"),
    )
    placed = numbered(leaves, ["doc_id", "hash"]).withColumn("leaf", F.col("hash"))
    paths, subroots = merkle_paths(placed, levels)
    subroots = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("lang_key"), F.col("root").alias("hash"))
    ordered = numbered(subroots, ["lang_key"])
    upper, tops = merkle_paths(ordered.withColumn("subroot", F.col("hash")), levels)
    langs = upper.join(tops, "grp").select("lang_key", "subroot", "root", F.col("path").alias("upper_path"))
    langs = written(langs, "langs")  # its size is known by then: Spark broadcasts it where it is small
    both = paths.join(langs, paths.grp == langs.lang_key)
    return both.select(
        "doc_id", "leaf", "subroot", "root",
        F.coalesce("tampered", "leaf").alias("tampered"),
        F.concat("path", "upper_path").alias("path"),
    )


def verified(rows: DataFrame) -> DataFrame:
    """The manifest's rows, each proven against the root from its tampered leaf and its siblings."""
    proven = rows.select(
        "doc_id", "leaf", "subroot", "root",
        proof_of(F.col("path")).alias("proof_sha256"),
        folded(F.col("path"), F.col("tampered")).alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))
