"""CSV records that hold line breaks, read by many tasks from byte ranges of the same file.

A task that starts in the middle of a file cannot know whether it starts inside quotes. So every line is read both
ways: does it end inside quotes if it starts outside, and if it starts inside? A line is thereby a step between
two states, the lines of a range together are one too, and going through the few ranges of a file tells in which
state each range starts. With that every task puts its own records together while it reads; only the pieces of
records that a range's edge cuts, and the first record of every range, are moved.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.session import kept

# What tasks run travels with the job, whether or not the workers have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Complete fields up to a comma, and a field that opens and does not close. A quote is one only at the start
# of a field; two inside quotes stand for one. Nothing here backtracks or recurses, however long the line.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:{_QUOTED}"[^,]*+|(?!")[^,]*+),)*+'
OPENS = rf"^{_FIELDS}{_QUOTED}\z"
STAYS_OPEN = rf'^[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,{_FIELDS}{_QUOTED}\z)'

EDGE_SCHEMA = "file long, block long, part int, text string"
# Pieces of a range at its edges: the end of a record begun before, its first own record, one that goes on after it.
ENDS, FIRST, BEGINS = 0, 1, 2
# Empty lines between records are no records.
EMPTY = ["", "\r"]


def has_large_files(spark: SparkSession, path: str) -> bool:
    """Whether some file is larger than one task's range. Sizes come from the listing; nothing is read."""
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    sizes = spark.read.format("binaryFile").load(path).select("length")
    return not sizes.where(F.col("length") > limit).limit(1).isEmpty()


def _stepped(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, if_outside, if_inside): every line with a hash of its file's path, the start of its range,
    and whether quotes are open after it, by the state before it."""
    value, quoted = F.col("value"), F.contains("value", F.lit('"'))
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # A line without quotes keeps the state.
        (quoted & value.rlike(OPENS)).alias("if_outside"),
        (~quoted | value.rlike(STAYS_OPEN)).alias("if_inside"),
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(file, name): the hash and the path of every file. Nothing is read."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("name"))
    return listed.select(F.xxhash64("name").alias("file"), "name")


class UnclosedQuote(ValueError):
    """A file ends inside quotes."""


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The parts of a batch that come from one range each."""
    file, block = (batch.column(name).to_numpy() for name in ("file", "block"))
    turns = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for low, high in zip([0, *turns.tolist()], [*turns.tolist(), len(file)]):
        if high > low:
            yield (int(file[low]), int(block[low])), batch.slice(low, high - low)


def _states(run: pa.RecordBatch, start: bool) -> np.ndarray:
    """Whether quotes are open after every line, by the state before the first."""
    outside, inside = (run.column(name).to_numpy(zero_copy_only=False) for name in ("if_outside", "if_inside"))
    # From the last line that ends the same way whatever came before, else from the start; others turn it or leave it.
    turned = np.cumsum(outside & ~inside)
    fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    odd = (turned - np.where(fixed >= 0, turned[fixed], 0)) % 2 == 1
    return np.where(fixed >= 0, outside[fixed], start) != odd


def _as_steps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: whether quotes are open at its end, by the state at its beginning."""
    ends: dict[tuple[int, int], tuple[bool, bool]] = {}
    for batch in batches:
        for key, run in _runs(batch):
            ends[key] = tuple(bool(_states(run, start)[-1]) for start in ends.get(key, (False, True)))
    columns = [*zip(*ends), *zip(*ends.values())] if ends else [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["file", "block", "if_outside", "if_inside"]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names)


def _starts(ranges: Iterable) -> tuple[dict[tuple[int, int], bool], list[int]]:
    """Whether each range starts inside quotes, and the files that end inside. As many rows as a scan has ranges."""
    starts, state, open_files, last = {}, False, [], None
    for row in sorted(ranges, key=lambda r: (r.file, r.block)):
        if row.file != last:
            open_files += [last] if state else []
            state, last = False, row.file
        starts[row.file, row.block] = state
        state = row.if_inside if state else row.if_outside
    return starts, open_files + ([last] if state else [])


class _Pieces:
    """The records of one range after the other: whole ones, and (file, block, part, text) of those at its edges."""

    def __init__(self, starts: Mapping[tuple[int, int], bool]):
        self.starts, self.key = starts, None
        self.edges: list[tuple[int, int, int, str]] = []

    def close(self) -> list[str]:
        """The end of a range; records that turned out whole."""
        whole = self._finished(BEGINS if self.state else FIRST) if self.key else []
        self.key = None
        return whole

    def open(self, key: tuple[int, int]) -> None:
        if key not in self.starts:
            raise RuntimeError("the source is read in other ranges than before; read it again")
        self.key, self.state = key, self.starts[key]
        # Lines of a record that may go on, whether it began in an earlier range, and whether the first own one is still to come.
        self.held, self.continued, self.fresh = [], self.state, True

    def _finished(self, part: int) -> list[str]:
        """What is held, as a piece of an edge or as a whole record."""
        if not self.held:
            return []
        text, self.held = "\n".join(self.held), []
        if self.continued:
            part = ENDS
        elif part == FIRST:
            if text in EMPTY:
                return []
            if not self.fresh:
                return [text]
            self.fresh = False
        self.edges.append((*self.key, part, text))
        return []

    def read(self, run: pa.RecordBatch) -> Iterator[pa.Array]:
        """The whole records that end in some lines of the range."""
        after = _states(run, self.state)
        begins = np.flatnonzero(~np.concatenate([[self.state], after[:-1]]))
        self.state = bool(after[-1])
        value = run.column("value")
        lead = int(begins[0]) if len(begins) else len(after)
        if lead:
            self.held.append("\n".join(value.slice(0, lead).to_pylist()))
        if not len(begins):
            return
        yield pa.array(self._finished(FIRST), pa.string())
        self.continued = False
        bounds = pa.array(np.append(begins, len(after)).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(bounds, value), "\n")
        # The last one may go on in the next lines.
        self.held = [joined[-1].as_py()]
        joined = joined.slice(0, len(joined) - 1)
        joined = joined.filter(pc.invert(pc.is_in(joined, pa.array(EMPTY))))
        if self.fresh and len(joined):
            self.edges.append((*self.key, FIRST, joined[0].as_py()))
            self.fresh, joined = False, joined.slice(1)
        yield joined


def _assembled(starts: Mapping[tuple[int, int], bool], edges: bool) -> Callable:
    """Either the pieces at the edges of ranges or the records inside them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(starts)

        def out(texts: pa.Array) -> Iterator[pa.RecordBatch]:
            if edges:
                found, pieces.edges = pieces.edges, []
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "block", "part", "text"])
            else:
                pieces.edges = []
                if len(texts):
                    yield pa.RecordBatch.from_arrays([texts], ["record"])

        for batch in batches:
            for key, lines in _runs(batch):
                if key != pieces.key:
                    yield from out(pa.array(pieces.close(), pa.string()))
                    pieces.open(key)
                for texts in pieces.read(lines):
                    yield from out(texts)
        yield from out(pa.array(pieces.close(), pa.string()))

    return run


def _bare(record: Column) -> Column:
    """A record without the carriage return that ends its last line, and then without those that end others."""
    feeds = F.replace(F.regexp_replace(record, r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    return F.when(record.endswith("\r"), feeds).otherwise(record)


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(record) of every record but the headers, and (file, record) of every file's header, as texts.

    Lines end with a line feed, with or without a carriage return before it; breaks inside quotes come out as line
    feeds. Empty lines between records are left out. All this is what Spark's reader of whole files does, but a file
    that ends inside quotes is an error here. The source is scanned three times and nothing of it is shuffled or
    written but at most three records or pieces of records a range, which are kept until the application ends.
    """
    lines, files = _stepped(spark, path), _files(spark, path)
    flags = ["file", "block", "if_outside", "if_inside"]
    ranges = lines.select(*flags).mapInArrow(_as_steps, "file long, block long, if_outside boolean, if_inside boolean")
    starts, unclosed = _starts(ranges.collect())
    if unclosed:
        name = files.where(F.col("file") == unclosed[0]).first()["name"]
        raise UnclosedQuote(f"{name}: a quote is never closed")
    edges = kept(lines.mapInArrow(_assembled(starts, True), EDGE_SCHEMA), "csv-edges")
    upto = Window.partitionBy("file").orderBy("block", "part")
    numbered = edges.withColumn("number", F.sum((F.col("part") != ENDS).cast("long")).over(upto))
    cut = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
    cut = cut.withColumn("record", _bare(F.array_join(F.transform("parts", lambda p: p["text"]), "\n")))
    inner = lines.mapInArrow(_assembled(starts, False), "record string").select(_bare(F.col("record")).alias("record"))
    # A file starts outside quotes, so its first record is the first of its first range that has one.
    tops = cut.where("number = 1").join(files, "file").select(F.col("name").alias("file"), "record")
    return inner.unionByName(cut.where("number > 1").select("record")), tops
