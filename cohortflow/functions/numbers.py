"""Numbers from text, without silent rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exact_decimal(text: Column, dtype: T.DecimalType) -> Column:
    """Text as a decimal; digits beyond its places are an error unless they are zeros."""
    value = text.cast(dtype)
    # Most texts are too short to have that many places, which is told without a search.
    plain = (F.octet_length(text) > dtype.scale + 1) & text.rlike(rf"\.\d{{{dtype.scale}}}\d*[1-9]")
    powers = (F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))) & (value.cast("double") != text.cast("double"))
    message = F.concat(F.lit(f"more than {dtype.scale} places: "), text)
    return F.when(plain | powers, F.raise_error(message).cast(dtype)).otherwise(value)
