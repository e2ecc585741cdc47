"""CSV reading: text first, then typed by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.numbers import exact_decimal
from cohortflow.session import require_ansi
from cohortflow.sources.csv_ranges import has_large_files, records

_BAD_LINE = "_bad_line"


def clean_header(name: str) -> str:
    """Header names are compared without case, padding or a byte-order mark."""
    return name.lstrip("\ufeff").strip().lower()


def _reader(spark: SparkSession, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
    )


def _too_many_fields(line: Column, width: int) -> Column:
    """Whether a line that does not fit the header is too long, not too short."""
    # Possessive throughout: a field of any length is passed over without recursion.
    bare = F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= width


def odd_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines with an odd number of quotes. Most lines have none, which is told without copying them."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.text(path).where(F.contains("value", F.lit('"')) & (quotes % 2 == 1))


def records_span_lines(spark: SparkSession, path: str) -> bool:
    """Whether some record may hold a line break inside quotes.

    Such a record's first line has an odd number of quotes, since a quote inside
    quotes is written twice. One pass of built-ins over the raw lines, which
    stops at the first find.
    """
    return not odd_lines(spark, path).limit(1).isEmpty()


def _parsed(record: Column, width: int) -> Column:
    """A record's fields c0, c1, ... as text, and the record itself where their number is not the header's."""
    schema = ", ".join(f"c{i} string" for i in range(width)) + f", {_BAD_LINE} string"
    return F.from_csv(record, schema, {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _BAD_LINE})


def _read_in_ranges(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The records of sources with line breaks inside quotes, under `names` and _BAD_LINE."""
    found, headers = records(spark, path)
    header = headers.select("file", _parsed(F.col("record"), len(names)).alias("h"))
    given = F.array(*[F.lower(F.trim(F.replace(F.col(f"h.c{i}"), F.lit("\ufeff"), F.lit("")))) for i in range(len(names))])
    wanted = F.array(*[F.lit(name) for name in names])
    other = header.where(~given.eqNullSafe(wanted) | F.col(f"h.{_BAD_LINE}").isNotNull()).select("file").limit(1).collect()
    if other:
        raise ValueError(f"{other[0]['file']}: its header is not that of the other files")
    return found.select(_parsed(F.col("record"), len(names)).alias("r")).select("r.*").toDF(*names, _BAD_LINE)


def read_csv(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """All columns as text under cleaned header names.

    `path` may be one file, a folder or a glob; every file must carry the same
    header. Lines shorter than the header are filled with NULL, longer ones stop
    the job. Files split over tasks where every record is one line, and so do files
    larger than a task's range where records hold line breaks (see csv_ranges); smaller
    files with such records are one task's each. `multiline` False promises that no
    record holds one, True reads each file whole; by default the files are looked
    through. The records are the same either way.
    """
    in_ranges = False
    if multiline is None:
        multiline = records_span_lines(spark, path)
        in_ranges = multiline and has_large_files(spark, path)
    header = _reader(spark, multiline).csv(path).columns
    names = [clean_header(name) for name in header]
    if not names:
        raise ValueError(f"{path}: no header")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"{path}: column given twice: {', '.join(repeated)}")
    if in_ranges:
        lines = _read_in_ranges(spark, path, names)
    else:
        fields = [T.StructField(name, T.StringType()) for name in header]
        schema = T.StructType([*fields, T.StructField(_BAD_LINE, T.StringType())])
        reader = _reader(spark, multiline).option("columnNameOfCorruptRecord", _BAD_LINE)
        lines = reader.schema(schema).csv(path).toDF(*names, _BAD_LINE)
    bad = F.col(_BAD_LINE)
    too_long = bad.isNotNull() & _too_many_fields(bad, len(names))
    first, *rest = names
    stop = F.raise_error(F.concat(F.lit(f"{path}: more fields than the header has: "), bad))
    return lines.select(
        F.when(too_long, stop).otherwise(F.col(f"`{first}`")).cast("string").alias(first),
        *[F.col(f"`{name}`") for name in rest],
    )


def _fits(df: DataFrame, field: T.StructField) -> bool:
    """Whether a column is a decimal of no more places than the field's: then a cast drops no digit."""
    given = df.schema[field.name].dataType
    return isinstance(given, T.DecimalType) and given.scale <= field.dataType.scale


def typed_by_name(
    df: DataFrame, schema: T.StructType, na_tokens: Sequence[str] = ("",)
) -> DataFrame:
    """Text columns cast by name to a table's schema.

    Missing-value tokens become NULL, columns the file lacks are NULL, and
    `loaded_at`, when lacking, is the time of the load. A column the table does not have, and
    text that does not fit its type, are errors.
    """
    require_ansi(df.sparkSession)
    unknown = [name for name in df.columns if name not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"unknown column: {', '.join(unknown)}")

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            text = F.col(field.name)
            value = F.when(~text.isin(*na_tokens), text) if na_tokens else text
        elif field.name == "loaded_at":
            value = F.current_timestamp()
        else:
            value = F.lit(None)
        if isinstance(field.dataType, T.DecimalType) and field.name in df.columns and not _fits(df, field):
            return exact_decimal(value, field.dataType).alias(field.name)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])
