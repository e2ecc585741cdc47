"""Declarative data checks and the gate that stops a run."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortflow.sources.tables import append, create_table


@dataclass(frozen=True)
class Check:
    """One rule on one column: 'unique', 'not_null', or a condition such as '>= 0'.

    'unique' takes several columns too, as "a, b".
    """

    table: str
    column: str
    rule: str

    def failing_rows(self) -> Column:
        """Per-row test for the rules that look at one row. A NULL passes a condition."""
        if self.rule == "not_null":
            return F.col(self.column).isNull()
        return F.expr(f"not (`{self.column}` {self.rule})")


# The checks every run must pass.
RUN_CHECKS = [
    Check("raw_patients", "id", "unique"),
    Check("raw_patients", "id", "not_null"),
    Check("raw_encounters", "id", "unique"),
    Check("raw_encounters", "id", "not_null"),
    Check("raw_encounters", "patient", "not_null"),
    Check("stg_patients", "patient_id", "unique"),
    Check("stg_patients", "patient_id", "not_null"),
    Check("stg_patients", "age", "not_null"),
    Check("stg_patients", "age", ">= 0"),
    Check("stg_encounters", "encounter_id", "unique"),
    Check("stg_encounters", "encounter_id", "not_null"),
    Check("stg_encounters", "patient_id", "not_null"),
    Check("dim_patients", "patient_id", "unique"),
    Check("dim_patients", "patient_id", "not_null"),
    Check("dim_patients", "total_encounters", ">= 0"),
    Check("fct_clinical_events", "event_id", "unique"),
    Check("fct_clinical_events", "event_id", "not_null"),
    Check("fct_clinical_events", "encounter_id", "not_null"),
    Check("high_risk_flag", "patient_id", "unique"),
    Check("high_risk_flag", "patient_id", "not_null"),
]


# The checks of the triage log.
LOG_CHECKS = [
    Check("triage_summaries", "patient_id", "not_null"),
    Check("triage_summaries", "run_date", "not_null"),
    Check("triage_summaries", "patient_id, run_date", "unique"),
]


class QualityError(RuntimeError):
    """Raised by the gate; lists the checks that failed."""


def _pass_over(df: DataFrame, unique: Check | None, others: Sequence[Check]) -> DataFrame:
    """All given checks of a table in one scan.

    The uniqueness test groups by its column; the row tests ride along as counts
    per group, so they need no scan of their own. Counts are combined before the
    shuffle, so a value holding most rows is no burden.
    """
    tests = [F.count_if(c.failing_rows()).alias(f"_f{i}") for i, c in enumerate(others)]
    if unique is None:
        totals = df.agg(*tests) if tests else None
        checks = list(others)
    else:
        names = [name.strip() for name in unique.column.split(",")]
        values = [F.col(name).alias(f"_v{i}") for i, name in enumerate(names)]
        per_value = df.groupBy(*values).agg(F.count("*").alias("_n"), *tests)
        given = reduce(lambda a, b: a & b, [F.col(f"_v{i}").isNotNull() for i in range(len(names))])
        repeated = F.count_if(given & (F.col("_n") > 1))
        totals = per_value.agg(
            *[F.coalesce(F.sum(f"_f{i}"), F.lit(0)).alias(f"_f{i}") for i in range(len(others))],
            repeated.alias(f"_f{len(others)}"),
        )
        checks = [*others, unique]
    rows = [
        F.struct(
            F.lit(c.table).alias("table"),
            F.lit(c.column).alias("column"),
            F.lit(c.rule).alias("check"),
            F.col(f"_f{i}").cast("bigint").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_tables(tables: Mapping[str, DataFrame], checks: Sequence[Check] = RUN_CHECKS) -> DataFrame:
    """One row (table, column, check, failures) per check.

    Failures of 'unique' are values occurring more than once, NULL aside; of the
    other rules, rows.
    """
    by_table: dict[str, list[Check]] = defaultdict(list)
    for check in checks:
        by_table[check.table].append(check)
    parts = []
    for table, group in by_table.items():
        uniques = [c for c in group if c.rule == "unique"] or [None]
        others = [c for c in group if c.rule != "unique"]
        parts.append(_pass_over(tables[table], uniques[0], others))
        parts.extend(_pass_over(tables[table], c, []) for c in uniques[1:])
    return reduce(DataFrame.unionByName, parts)


def _failing(df: DataFrame, table: str, checks: Sequence[Check], key: str | None) -> DataFrame:
    """The failing rows of one table, once per rule they fail."""

    def found(check: Check) -> list[Column]:
        names = [name.strip() for name in check.column.split(",")]
        value = F.concat_ws(", ", *[F.col(name).cast("string") for name in names]) if len(names) > 1 else F.col(names[0])
        return [F.lit(check.column).alias("column"), F.lit(check.rule).alias("check"), value.cast("string").alias("value")]

    row_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    row = [row_key.alias("row_key"), F.to_json(F.struct(*df.columns)).alias("row")]
    head = F.lit(table).alias("table")
    others = [c for c in checks if c.rule != "unique"]
    parts = []
    if others:
        # All row rules in one pass. Rows that pass all of them are dropped by a plain filter, which Spark moves
        # below the joins a model is made of.
        some = reduce(lambda a, b: a | b, [F.coalesce(c.failing_rows(), F.lit(False)) for c in others])
        hits = F.filter(F.array(*[F.when(c.failing_rows(), F.struct(*found(c))) for c in others]), lambda x: x.isNotNull())
        parts.append(df.where(some).select(head, *row, F.inline(hits)))
    for check in checks:
        if check.rule == "unique":
            names = [name.strip() for name in check.column.split(",")]
            given = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])
            # Counted before it is shuffled; only the repeated values meet the rows again.
            again = df.where(given).groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
            parts.append(df.join(again, names, "left_semi").select(head, *row, *found(check)))
    columns = ["table", "column", "check", "row_key", "value", "row"]
    return reduce(DataFrame.unionByName, parts).select(*columns)


def failing_rows(
    tables: Mapping[str, DataFrame], checks: Sequence[Check] = RUN_CHECKS, keys: Mapping[str, str] | None = None
) -> DataFrame:
    """The rows behind check_tables' counts: (table, column, check, row_key, value, row), one per row and rule it fails.

    `row` is the whole row as JSON, `value` the checked column, `row_key` the column `keys` names for the table.
    Of 'unique' every row of a repeated value is listed. Row rules share one scan a table without a shuffle.

    Tables with a 'unique' rule are counted first, by one job that runs at once and moves a row per value: only the
    checks that fail there have their rows looked for, so a table without failures is not computed again. Give tables
    that do not change between this call and the reading of its result.
    """
    by_table: dict[str, list[Check]] = defaultdict(list)
    for check in checks:
        by_table[check.table].append(check)
    counted = [c for group in by_table.values() if any(c.rule == "unique" for c in group) for c in group]
    passed = set()
    if counted:
        counts = check_tables(tables, counted).collect()
        passed = {Check(r["table"], r["column"], r["check"]) for r in counts if not r["failures"]}

    def listed(passed: set[Check]) -> list[DataFrame]:
        left = {name: [c for c in group if c not in passed] for name, group in by_table.items()}
        return [_failing(tables[name], name, group, (keys or {}).get(name)) for name, group in left.items() if group]

    parts = listed(passed)
    return reduce(DataFrame.unionByName, parts) if parts else listed(set())[0].limit(0)


def log_failures(
    tables: Mapping[str, DataFrame],
    target: str,
    checks: Sequence[Check] = RUN_CHECKS,
    keys: Mapping[str, str] | None = None,
) -> int:
    """Append the failing rows to table `target`, created where it is missing, and return their number."""
    found, seen = failing_rows(tables, checks, keys), Observation()
    create_table(found.sparkSession, target, found.schema)
    append(found.observe(seen, F.count(F.lit(1)).alias("n")), target)
    return seen.get.get("n", 0)


def gate(report: DataFrame) -> list:
    """Run the checks and stop if any fails. The report holds one row per check."""
    rows = report.collect()
    failed = [f"{r['table']}.{r['column']} {r['check']}: {r['failures']}" for r in rows if r["failures"]]
    if failed:
        raise QualityError("failed checks: " + "; ".join(failed))
    return rows
