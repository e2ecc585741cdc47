"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BREAK = "\x01 "


def title_words(text: Column) -> Column:
    """Lower-case, then capitalise the first character after every non-alphanumeric.

    Spark's initcap starts words at spaces only, so a marked space is put after
    each separator for it to see and is taken out again. Built-ins only: the
    expression stays inside whole-stage codegen.
    """
    marked = F.regexp_replace(F.lower(text), r"([^\p{L}\p{N}])", "$1" + _BREAK)
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Both names in title case; NULL when either is NULL."""
    return F.concat(title_words(first), F.lit(" "), title_words(last))


def surrogate_key(*cols: Column, null_token: str = "\x00null") -> Column:
    """MD5 over the columns' text, joined by a dash; NULL and empty text give different keys."""
    parts = [F.coalesce(c.cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws("-", *parts))
