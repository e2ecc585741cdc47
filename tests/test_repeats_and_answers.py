"""Bag difference, exact samples, failing rows, and answers that outlive a killed run."""

import datetime as dt
from collections import Counter
from itertools import islice

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators import difference
from cohortflow.operators.answers import answer_in_batches, answer_key, answered, missing_answers
from cohortflow.operators.difference import new_occurrences, repeated, stored_counts
from cohortflow.operators.scoring import each_prompt
from cohortflow.operators.selection import exact_sample
from cohortflow.plans.quality import Check, check_tables, failing_rows, log_failures
from cohortflow.plans.triage import keyed_prompts, run_triage
from cohortflow.schemas import SUMMARY_SCHEMA
from cohortflow.session import staged
from cohortflow.sources.loader import load_file, load_folder
from cohortflow.sources.tables import create_table

DAY = dt.date(2024, 5, 1)


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_bag_difference(spark):
    schema = "a string, b string, n int"
    old = [("x", None, 1)] * 3 + [(None, "x", 1), ("y", "", 2), ("z", "z", None)]
    new = [("x", None, 1)] * 25_003 + [(None, "x", 1)] * 2 + [("y", None, 2), ("y", "", 2), ("z", "z", 0), (None, None, None), (None, None, None)]
    incoming, existing = spark.createDataFrame(new, schema).repartition(4), spark.createDataFrame(old, schema)
    known = stored_counts(incoming, existing, ["a", "b", "n"])
    assert bag(new_occurrences(incoming, known, ["a", "b", "n"])) == Counter(new) - Counter(old)
    assert new_occurrences(incoming.limit(0), known, ["a", "b", "n"]).count() == 0


def test_stored_rows_are_hardly_shuffled(spark):
    old = spark.range(20_000).selectExpr("id", "cast(id % 7 as string) as text")
    new = old.where("id >= 50").unionByName(spark.range(30_000, 30_100).selectExpr("id", "'n' as text")).unionByName(old.where("id in (60, 61)"))
    with staged(stored_counts(new, old, ["id", "text"]), "known") as known:
        assert rows(known.select("m", "s")) == [(1, 0)] * 100 + [(2, 1)] * 2
        found = new.withColumns(dict(zip(difference.FINGERPRINT, difference.fingerprint(["id", "text"]))))
        kept = difference.among(found, known, known.count())
        assert 104 <= kept.count() < 3_000 and "hashpartitioning(f1" not in kept._jdf.queryExecution().executedPlan().toString()
        assert bag(new_occurrences(new, known, ["id", "text"])) == bag(new) - bag(old)


def test_rows_are_copied_in_short_runs(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10_000), ("d", 10_001), ("e", 35_000)], "v string, t long")
    assert Counter(r.v for r in repeated(df, "t").collect()) == {"b": 1, "c": 10_000, "d": 10_001, "e": 35_000}


def test_a_file_loaded_twice_adds_nothing_and_its_repeats_stay(spark, databases, tmp_path):
    path = tmp_path / "conditions.csv"
    path.write_text("PATIENT,CODE\np1,1\np1,1\np2,\n,\n")
    loads = [load_file(spark, str(path), "conditions", dedupe=True) for _ in range(2)]
    assert [(x.read, x.skipped, x.inserted) for x in loads] == [(4, 0, 4), (4, 4, 0)]
    path.write_text("PATIENT,CODE\np1,1\np1,1\np1,1\np3,7\n")
    assert load_folder(spark, str(tmp_path), dedupe=True).total == 2
    assert rows(spark.table("raw.conditions"), "patient", "code") == rows(
        spark.createDataFrame([("p1", "1")] * 3 + [("p2", None), ("p3", "7"), (None, None)], "a string, b string")
    )


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.6, 0.999, 1.0])
def test_an_exact_share_of_rows(spark, fraction):
    data = [(f"k{i}", i) for i in range(20_000)] + [("hot", i % 7) for i in range(11_000)] + [(None, 1)] * 12_000
    df = spark.createDataFrame(data, "k string, v int").repartition(5)
    got = exact_sample(df, "k", fraction, 7)
    assert got.count() == round(fraction * len(data))
    assert not bag(got) - Counter(data)
    assert bag(exact_sample(df.repartition(3), "k", fraction, 7)) == bag(got)
    if 0 < fraction < 1:
        assert bag(exact_sample(df, "k", fraction, 8)) != bag(got)


def test_samples_of_empty_and_tiny_tables(spark):
    df = spark.createDataFrame([("a",)], "k string")
    assert exact_sample(df.limit(0), "k", 0.5).count() == 0
    assert exact_sample(df, "k", 0.4).count() == 0 and exact_sample(df, "k", 0.6).count() == 1


def test_failing_rows_stand_behind_the_counts(spark, databases):
    df = spark.createDataFrame([("a", 1), ("a", -2), (None, None), ("b", -3), (None, 4)], "id string, n int")
    checks = [Check("t", "id", "unique"), Check("t", "id", "not_null"), Check("t", "n", ">= 0"), Check("t", "id, n", "unique")]
    found = failing_rows({"t": df}, checks, {"t": "id"})
    assert rows(found.drop("table", "row")) == rows(
        spark.createDataFrame(
            [("id", "unique", "a", "a")] * 2 + [("id", "not_null", None, None)] * 2
            + [("n", ">= 0", "a", "-2"), ("n", ">= 0", "b", "-3")], "a string, b string, c string, d string",
        )
    )
    assert '{"id":"b","n":-3}' in [r.row for r in found.collect()]
    counts = {(r.column, r["check"]): r.failures for r in check_tables({"t": df}, checks).collect()}
    assert counts == {("id", "unique"): 1, ("id", "not_null"): 2, ("n", ">= 0"): 2, ("id, n", "unique"): 0}
    assert [log_failures({"t": df}, "analytics.failures", checks) for _ in range(2)] == [6, 6]
    assert spark.table("analytics.failures").count() == 12
    plan = failing_rows({"t": df}, checks[1:3])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def counting(folder, bad=()):
    """A scorer that notes every prompt it is asked in a file of its own."""

    def open_client():
        def call(prompt):
            name = prompt.split()[-1]
            with open(f"{folder}/{name}", "a") as out:
                out.write("x")
            if name in bad:
                raise TimeoutError(name)
            return ('{"risk_score": 1, "risk_label": "LOW", "summary": "s"}', "m", 1, 2)

        return call

    return each_prompt(open_client)


def asked_of(folder):
    return {p.name: len(p.read_text()) for p in folder.iterdir()}


def test_a_killed_run_leaves_its_answers(spark, databases, tmp_path):
    todo = spark.createDataFrame([(f"p{i}", f"about p{i}") for i in range(60)], "patient_id string, prompt string")
    asked = keyed_prompts(todo, DAY)
    first = list(islice(answer_in_batches(asked, "analytics.answers", counting(tmp_path), 15), 2))
    seen = asked_of(tmp_path)
    assert sum(first) == len(seen) and 0 < len(seen) < 60
    assert missing_answers(asked, spark.table("analytics.answers")).count() == 60 - len(seen)
    again = sum(answer_in_batches(asked, "analytics.answers", counting(tmp_path), 15))
    assert again == 60 - len(seen) and asked_of(tmp_path) == {f"p{i}": 1 for i in range(60)}
    assert list(answer_in_batches(asked, "analytics.answers", counting(tmp_path), 15)) == []
    got = answered(asked, spark.table("analytics.answers"))
    assert got.count() == 60 and got.where("raw_response is null").count() == 0


def test_failed_answers_are_asked_again_and_other_days_anew(spark, databases, tmp_path):
    todo = spark.createDataFrame([("a", "about a"), ("b", "about b"), ("b", "about b")], "patient_id string, prompt string")
    asked = keyed_prompts(todo, DAY)
    assert sum(answer_in_batches(asked, "analytics.answers", counting(tmp_path, {"b"}))) == 2
    failed = answered(asked, spark.table("analytics.answers")).where("scorer_error is not null")
    assert [r.patient_id for r in failed.collect()] == ["b", "b"]
    assert sum(answer_in_batches(asked, "analytics.answers", counting(tmp_path))) == 1
    assert answered(asked, spark.table("analytics.answers")).where("scorer_error is not null").count() == 0
    assert asked_of(tmp_path) == {"a": 1, "b": 2}
    assert sum(answer_in_batches(keyed_prompts(todo, DAY + dt.timedelta(1)), "analytics.answers", counting(tmp_path))) == 2


def test_parts_of_a_key_cannot_run_into_each_other(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("1:a", ""), ("", "1:a"), (None, "x"), ("-", "x"), ("", None)], "a string, b string")
    assert df.select(answer_key(F.col("a"), F.col("b"))).distinct().count() == 7


def test_triage_whose_append_fails_pays_once(spark, databases, tmp_path, monkeypatch):
    from cohortflow.plans import triage

    create_table(spark, "analytics.log", SUMMARY_SCHEMA, partition_by="run_date")
    people = pd.DataFrame({"patient_id": [f"p{i}" for i in range(7)], "age": 70})
    people["full_name"] = people.patient_id
    profile = {name: None for name in triage.CANDIDATE_COLUMNS if name not in people}
    high_risk = spark.createDataFrame(people).select("*", *[F.lit(None).cast("string").alias(n) for n in profile])

    def prompts(df):
        return df.select("patient_id", F.concat(F.lit("about "), "patient_id").alias("prompt"))

    monkeypatch.setattr(triage, "prompts", prompts)
    real, calls = triage.append_summaries, []

    def broken(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("no room")
        real(*args)

    monkeypatch.setattr(triage, "append_summaries", broken)
    with staged(high_risk, "people") as people:
        reports = [
            str(run_triage(people, "analytics.log", counting(tmp_path), DAY, answers="analytics.answers", batch_rows=3)) for _ in range(3)
        ]
    assert reports == [
        "Triage complete. Processed=0, Skipped=0, Errors=7",
        "Triage complete. Processed=7, Skipped=0, Errors=0",
        "Triage complete. Processed=0, Skipped=7, Errors=0",
    ]
    assert asked_of(tmp_path) == {f"p{i}": 1 for i in range(7)}


def test_tables_without_failures_are_not_read_for_failing_rows(spark):
    """What the counts cleared is left out of the plan; what they did not look at or found is in it."""
    good = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int").withColumn("good_mark", F.lit(1))
    bad = spark.createDataFrame([("a", 1), ("a", None), (None, 7)], "id string, m int")
    rule = [("id", "unique"), ("id", "not_null")]
    checks = [Check(t, *r) for t in ("good", "bad") for r in rule] + [Check("good", "n", "> 0"), Check("rows", "m", "not_null")]
    tables = {"good": good, "bad": bad, "rows": bad}
    found = failing_rows(tables, checks, {"good": "id", "bad": "id", "rows": "id"})
    assert "good_mark" not in found._jdf.queryExecution().analyzed().toString()
    assert rows(found.drop("row")) == rows(
        spark.createDataFrame(
            [("bad", "id", "unique", "a", "a")] * 2 + [("bad", "id", "not_null", None, None), ("rows", "m", "not_null", "a", None)],
            "a string, b string, c string, d string, e string",
        )
    )
    none = failing_rows({"good": good}, [c for c in checks if c.table == "good"])
    assert none.columns == found.columns and none.count() == 0


def test_row_rules_are_looked_for_below_a_model_s_joins(spark, tmp_path):
    """A rule over one side's column drops that side's rows before they are moved."""
    spark.range(100).selectExpr("id", "nullif(id % 10, 3) as code").write.parquet(f"{tmp_path}/left")
    spark.range(100).write.parquet(f"{tmp_path}/right")
    model = spark.read.parquet(f"{tmp_path}/left").join(spark.read.parquet(f"{tmp_path}/right"), "id")
    found = failing_rows({"m": model}, [Check("m", "code", "not_null")], {"m": "id"})
    assert found.count() == 10
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan[: plan.index("Join")] and "isnull(code" in plan[plan.index("Join") :]
