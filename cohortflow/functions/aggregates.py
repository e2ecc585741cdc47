"""Aggregate expressions that let several per-key summaries share one groupBy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.numbers import exact_decimal


def latest(value: Column, order: Sequence[Column], where: Column | None = None) -> Column:
    """The value from the row that sorts first by `order`, descending, NULLs first.

    Only rows passing `where` compete. The winner is kept whole: a struct value
    keeps its NULL fields rather than filling them from older rows. Each map task
    sends on one candidate per key, however many rows the key has.
    """
    rank = F.struct(*[part for c in order for part in (c.isNull(), c)])
    return F.max_by(value, rank if where is None else F.when(where, rank))


def distinct_count(value: Column, where: Column) -> Column:
    """COUNT(DISTINCT value) over the rows passing `where`; NULL when no row passes.

    A set is used so that no row expansion or second shuffle is planned for the
    distinct; its size is bounded by the code vocabulary, not by the row count.
    """
    seen = F.collect_set(F.when(where, value))
    return F.when(F.max(F.coalesce(where, F.lit(False))), F.size(seen).cast("bigint"))


def distinct_text(value: Column, where: Column | None = None, sep: str = "; ") -> Column:
    """The distinct non-NULL values in ascending order as one text; NULL when none."""
    seen = F.collect_set(value if where is None else F.when(where, value))
    return F.when(F.size(seen) > 0, F.array_join(F.sort_array(seen), sep))


def measure_columns(
    code: Column, value: Column, mapping: Mapping[str, str], dtype: str
) -> list[Column]:
    """One MAX(CASE …) per code. The cast sits inside the CASE: text under other codes is never cast."""
    kind = T.DataType.fromDDL(dtype)
    return [
        F.max(F.when(code == wanted, exact_decimal(value, kind))).alias(name)
        for wanted, name in mapping.items()
    ]
