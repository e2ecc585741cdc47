import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.dates import as_of_column, completed_years, days_since, iso_text, minutes_between
from cohortflow.functions.numbers import exact_decimal
from cohortflow.functions.text import full_name, surrogate_key, title_words


def test_completed_years_edges(spark):
    cases = [
        ("2000-02-29", "2023-02-28", 22),
        ("2000-02-29", "2023-03-01", 23),
        ("2005-06-01", "2001-01-01", -4),
        ("1990-05-05", "1990-05-05", 0),
        ("1990-05-05", "2020-05-04", 29),
        (None, "2020-01-01", None),
    ]
    df = spark.createDataFrame(cases, "b string, e string, want int")
    got = df.select(completed_years(F.col("b").cast("date"), F.col("e").cast("date")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in got.collect())


def test_completed_years_against_brute_force(spark):
    random.seed(5)
    pairs = []
    for _ in range(500):
        lo, hi = sorted(dt.date(1900, 1, 1) + dt.timedelta(days=random.randrange(45000)) for _ in range(2))
        years = 0
        while (lo.year + years + 1, lo.month, lo.day) <= (hi.year, hi.month, hi.day):
            years += 1
        pairs += [(lo, hi, years), (hi, lo, -years)]
    df = spark.createDataFrame(pairs, "b date, e date, want int")
    assert df.where(completed_years(F.col("b"), F.col("e")) != F.col("want")).count() == 0


def test_title_words(spark):
    cases = [
        ("O'BRIEN-smith de la cruz", "O'Brien-Smith De La Cruz"),
        ("mary_ann 2nd", "Mary_Ann 2nd"),
        ("  élan d'été", "  Élan D'Été"),
        ("a\x01 b\x01c", "A\x01 B\x01C"),
        ("", ""),
        (None, None),
    ]
    df = spark.createDataFrame(cases, "s string, want string")
    assert df.where(~title_words(F.col("s")).eqNullSafe(F.col("want"))).count() == 0


def test_title_words_against_brute_force(spark):
    random.seed(6)
    texts = ["".join(random.choices("abcXYZéÑ019 '-_.,\t\x01", k=random.randrange(1, 25))) for _ in range(400)]

    def title(text):
        out, start = "", True
        for ch in text.lower():
            out += ch.upper() if start else ch
            start = not ch.isalnum()
        return out

    df = spark.createDataFrame([(t, title(t)) for t in texts], "s string, want string")
    assert df.where(title_words(F.col("s")) != F.col("want")).collect() == []


def test_full_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("ann", "LEE"), ("ann", None), (None, "lee")], "a string, b string")
    assert [r[0] for r in df.select(full_name(F.col("a"), F.col("b"))).collect()] == ["Ann Lee", None, None]


def test_minutes_and_days_do_not_depend_on_the_time_zone(spark):
    df = spark.sql(
        "select timestamp_ntz'2021-03-14 01:30:00' a, timestamp_ntz'2021-03-14 03:45:30' b, "
        "timestamp_ntz'2021-03-14 02:30:00' gap"
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = df.select(
            minutes_between(F.col("a"), F.col("b")).alias("m"),
            minutes_between(F.col("a"), F.col("gap")).alias("g"),
            minutes_between(F.col("b"), F.col("a")).alias("neg"),
            days_since(as_of_column("2021-03-20"), F.col("b")).alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(got) == (135.5, 60.0, -135.5, 6)


def test_as_of_defaults_to_today(spark):
    got = spark.range(1).select(as_of_column() == F.current_date(), iso_text(as_of_column(dt.date(2001, 9, 1))))
    assert tuple(got.first()) == (True, "2001-09-01")


def test_surrogate_key(spark):
    df = spark.createDataFrame([("enc-1", 7), ("enc-2", None)], "a string, b int")
    one = rows(df.select(surrogate_key(F.col("a"))))
    assert one == rows(df.select(F.md5("a")))
    two = [r[0] for r in df.select(surrogate_key(F.col("a"), F.col("b"), null_token="~")).collect()]
    assert two == [hashlib.md5(s.encode()).hexdigest() for s in ("enc-1-7", "enc-2-~")]


def test_null_and_empty_text_have_different_keys(spark):
    df = spark.createDataFrame([("",), (None,)], "a string")
    assert len({r[0] for r in df.select(surrogate_key(F.col("a"))).collect()}) == 2


def test_exact_decimal_keeps_every_digit_or_stops(spark):
    kind = T.DecimalType(38, 10)
    df = spark.createDataFrame([("40.00004",), ("1.50000000000000",), ("2e-3",), (None,)], "s string")
    got = [r[0] for r in df.select(exact_decimal(F.col("s"), kind)).collect()]
    assert got == [Decimal("40.00004"), Decimal("1.5"), Decimal("0.002"), None]
    for text in ("0.12345678901", "1e-11"):
        with pytest.raises(Exception, match="more than 10 places"):
            spark.createDataFrame([(text,)], "s string").select(exact_decimal(F.col("s"), kind)).collect()
