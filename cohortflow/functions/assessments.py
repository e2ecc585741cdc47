"""Reading a scorer's JSON response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys a response must hold, and the characters stripped around it.
RESPONSE_KEYS = ("risk_score", "risk_label", "summary")
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(text, F.lit(WHITESPACE))


def framed_json(raw: Column) -> Column:
    """The text parsed as the first item of an array whose second item is the text's own hash.

    Spark's JSON readers stop after the first value and so accept trailing text.
    In the frame the hash is found in second place only if the parser consumed
    exactly one value up to the end of the text.
    """
    text = strip(raw)
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text), F.lit('"]')))


def _as_integer(value: Column, kind: Column) -> Column:
    """Numbers round half away from zero; text must itself be an integer; else NULL."""
    number = F.round(F.try_variant_get(value, "$", "decimal(38,10)"), 0)
    digits = strip(F.try_variant_get(value, "$", "string"))
    return F.when(
        kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), number.try_cast("int")
    ).when((kind == "STRING") & digits.rlike("^[+-]?[0-9]+$"), digits.try_cast("int"))


def parse_assessment(raw: Column, framed: Column | None = None) -> Column:
    """struct<risk_score int, risk_label string, summary string, problem string>.

    `problem` is NULL for a usable response: one JSON object and nothing else,
    with all required keys, a score that is NULL or fits an integer column, and
    texts that are scalars. Values are not range-checked. With a problem, the
    other fields hold what could be read and are not to be used. Give `framed`, a column
    holding framed_json(raw), to have each text parsed just once.
    """
    parsed = framed_json(raw) if framed is None else framed
    whole = F.coalesce(F.try_variant_get(parsed, "$[1]", "string") == F.md5(strip(raw)), F.lit(False))
    item = {key: F.try_variant_get(parsed, f"$[0].{key}", "variant") for key in RESPONSE_KEYS}
    kind = {key: F.schema_of_variant(value) for key, value in item.items()}
    is_object = F.schema_of_variant(F.try_variant_get(parsed, "$[0]", "variant")).startswith("OBJECT")
    missing = F.greatest(*[value.isNull() for value in item.values()])
    nested = F.greatest(
        *[kind[key].rlike("^(OBJECT|ARRAY)") for key in ("risk_label", "summary")]
    )
    score = _as_integer(item["risk_score"], kind["risk_score"])
    problem = (
        F.when(~whole, "response is not one JSON document")
        .when(~is_object, "response is not a JSON object")
        .when(missing, "response lacks a required key")
        .when(score.isNull() & (kind["risk_score"] != "VOID"), "risk_score is not an integer")
        .when(nested, "risk_label or summary is not a scalar")
    )
    texts = [F.try_variant_get(item[key], "$", "string").alias(key) for key in ("risk_label", "summary")]
    return F.struct(score.alias("risk_score"), *texts, problem.alias("problem"))
