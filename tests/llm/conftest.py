import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from llm.cases import CLASHING, DOCS, SF_DIR, prose  # noqa: E402


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in every column, empty, blank, short and very long texts, copies, near copies, ties, repeated rows."""
    rnd = random.Random(4)
    base = prose(rnd, 120)
    edited = base.split()
    edited[60] = "changed"
    long = prose(rnd, 60_000, 5_000)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, " ".join(edited), "en", "a"),
        (4, None, "en", "a"), (5, "", "en", "a"), (6, " \t\n\x0b\f\r ", "en", "a"),
        (7, "One two", "en", None), (8, "ONE  TWO", None, "b"), (9, long, "en", "a"),
        (10, "Zürich 日本 🙂 <|endoftext|> don't\x1cstop\x85now\xa0here ½", "de", "b"),
        (11, "12345 !!! 678", None, "a"), (12, prose(rnd, 300), "en", "b"), (12, prose(rnd, 300), "en", "b"),
        (13, "same text here", "en", "a"), (13, "same text here", "en", "a"),
        (None, prose(rnd, 50), "en", "a"), (None, base, None, None), (None, None, None, None),
        (14, "a " * 500, "en", "a"), (15, base + " " + prose(rnd, 500), "fr", "a"), (-3, base, "en", "a"),
    ]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, DOCS)
    return df.select("*", *[F.lit("extra").alias(name) for name in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def sample_rows(sample):
    return sample.collect()
