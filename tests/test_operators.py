import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.functions.aggregates import distinct_count, distinct_text, latest
from cohortflow.operators.difference import already_stored, new_rows_only
from cohortflow.operators.reshape import hashed_count, k_of_n_explode, pivot_measures
from cohortflow.operators.selection import first_per_key, hash_sample, top_rows
from cohortflow.operators.text_lists import join_ordered_text


def test_first_per_key_orders_nulls_last_and_breaks_ties_by_the_rest(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 9), ("a", "x", 3), ("b", None, None), ("b", "y", 5), (None, "n", 0)],
        "k string, o string, v int",
    )
    assert rows(first_per_key(df, ["k"], ["o"])) == [("a", "x", 3), ("b", "y", 5), (None, "n", 0)]


def test_latest_puts_null_order_first_and_keeps_null_fields(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 5), ("a", 2, None, None), ("b", None, "first", 1), ("b", 9, "y", 2), ("c", 1, "z", None)],
        "k string, o int, v string, w int",
    )
    got = df.groupBy("k").agg(
        latest(F.struct("v", "w"), [F.col("o")]).alias("s"),
        latest(F.col("v"), [F.col("o")], F.col("w").isNotNull()).alias("with_w"),
    )
    assert rows(got, "k", "s.v", "s.w", "with_w") == [
        ("a", None, None, "x"),
        ("b", "first", 1, "first"),
        ("c", "z", None, None),
    ]


def test_pivot_takes_largest_and_casts_mapped_codes_only(spark):
    df = spark.createDataFrame(
        [("e", "a", "9"), ("e", "a", "10"), ("e", "t", "n/a"), ("f", "t", "n/a"), ("e", "b", " 1.5 ")],
        "k string, code string, value string",
    )
    wide = pivot_measures(df, ["k"], {"a": "aa", "b": "bb"}, "decimal(18,4)")
    got = wide.selectExpr("k", "cast(aa as double)", "cast(bb as double)")
    assert rows(got) == [("e", 10.0, 1.5), ("f", None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pivot_measures(df, ["k"], {"t": "tt"}, "decimal(18,4)").collect()


def test_distinct_text_and_count(spark):
    df = spark.createDataFrame(
        [("a", "1", "y", True), ("a", "1", "x", True), ("a", "2", "y", True), ("a", "3", "z", False),
         ("b", None, None, True), ("c", "1", "x", False), ("d", "1", "x", None)],
        "k string, code string, t string, f boolean",
    )
    got = df.groupBy("k").agg(
        distinct_count(F.col("code"), F.col("f")).alias("n"), distinct_text(F.col("t"), F.col("f")).alias("s")
    )
    assert rows(got) == [("a", 2, "x; y"), ("b", 0, None), ("c", None, None), ("d", None, None)]


def test_ordered_text(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01", "old", True), ("a", None, "undated", True), ("a", "2021-01-01", "new", True),
         ("a", "2021-01-01", "new", True), ("a", "2021-01-01", "alpha", True), ("a", "2022-01-01", "gone", False),
         ("a", "2019-01-01", None, True), ("b", "2020-01-01", "gone", False), ("c", "2020-01-01", None, True),
         ("d", "2020-01-01", "unknown flag", None)],
        "k string, d string, t string, f boolean",
    )
    got = join_ordered_text(df, ["k"], F.col("t"), F.col("d"), F.col("f"), "list")
    assert rows(got) == [
        ("a", "undated; alpha; new; new; old"), ("b", None), ("c", None), ("d", None),
    ]
    short = join_ordered_text(df, ["k"], F.col("t"), F.col("d"), F.col("f"), "list", every_key=False)
    assert rows(short) == [("a", "undated; alpha; new; new; old")]


def test_new_rows_only_keeps_null_keys(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, v int")
    old = spark.createDataFrame([("a",), (None,), ("a",)], "id string")
    assert rows(new_rows_only(new, old, ["id"])) == [("b", 2), (None, 3)]
    assert rows(already_stored(new, old, ["id"])) == [("a", 1)]


def test_top_rows(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 9), ("d", 9)], "id string, age int")
    top = top_rows(df, [F.col("age").desc_nulls_first(), F.col("id").asc()], 3)
    assert [r["id"] for r in top.collect()] == ["b", "c", "d"]


def test_hash_sample_is_exact_and_repeatable(spark):
    df = spark.range(2000).selectExpr("concat('k', id) as id")
    kept = {r[0] for r in hash_sample(df, "id", 0.3, 11).collect()}
    limit = int(0.3 * 2**32)
    want = {f"k{i}" for i in range(2000) if int(hashlib.md5(f"11k{i}".encode()).hexdigest()[:8], 16) < limit}
    assert kept == want and 500 < len(kept) < 700
    assert hash_sample(df, "id", 1.0).count() == 2000
    assert hash_sample(df, "id", 0).count() == 0


def test_k_of_n_against_brute_force(spark):
    catalogue = ["p", "q", "r", "s", "t"]
    df = spark.range(300).selectExpr("concat('e', id) as id")
    got = k_of_n_explode(df, "id", catalogue, hashed_count(F.col("id"), 2, 5))

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    want = []
    for i in range(300):
        key = f"e{i}"
        k = 2 + int(md5(key)[:8], 16) % 4
        want += [(key, c) for c in sorted(catalogue, key=lambda c: md5(c + key))[:k]]
    assert rows(got) == sorted(want)


def test_rows_without_key_are_sampled_and_exploded_like_others(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "k string")
    nearly, whole = (hash_sample(df, "k", f) for f in (0.999999999, 1.0))
    assert nearly.count() == whole.count() == 4
    out = k_of_n_explode(df, "k", ["x", "y", "z"], hashed_count(F.col("k"), 2, 3))
    per = {r[0]: r[1] for r in out.groupBy("k").count().collect()}
    assert per.keys() == {"a", "b", None} and per[None] >= 4
