"""Scoring rows with a caller-supplied function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortflow.schemas import RESPONSE_SCHEMA

# A factory makes the scorer, once per partition: the place to open a client.
# The scorer maps a batch of prompts to the columns of RESPONSE_SCHEMA, in the same order.
BatchScorer = Callable[[pd.Series], pd.DataFrame]
ScorerFactory = Callable[[], BatchScorer]


def score_rows(
    df: DataFrame, factory: ScorerFactory, prompt: str = "prompt", partitions: int | None = None
) -> DataFrame:
    """Add the scorer's response columns to every row of df.

    A batch whose scorer raises is returned with the reason in scorer_error and
    does not stop the others. Spark may run a task twice, so callers that pay per
    call write the result once before using it (see plans.triage).
    """
    dtypes = {
        f.name: "Int32" if isinstance(f.dataType, T.IntegerType) else "string"
        for f in RESPONSE_SCHEMA.fields
    }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for batch in batches:
            try:
                scorer = scorer or factory()
                answer = scorer(batch[prompt]).reindex(columns=list(dtypes)).astype(dtypes)
                if len(answer) != len(batch):
                    raise ValueError(f"scorer gave {len(answer)} answers for {len(batch)} prompts")
            except Exception as exc:
                answer = pd.DataFrame(index=batch.index, columns=list(dtypes)).astype(dtypes)
                answer["scorer_error"] = f"{type(exc).__name__}: {exc}"
            answer.index = batch.index
            yield pd.concat([batch, answer], axis=1)

    schema = T.StructType(df.schema.fields + RESPONSE_SCHEMA.fields)
    spread = df if partitions is None else df.repartition(partitions)
    return spread.mapInPandas(run, schema)


def each_prompt(call_factory: Callable[[], Callable[[str], tuple]]) -> ScorerFactory:
    """Adapt a one-prompt call, as remote services offer, keeping failures to their row.

    The call returns (raw_response, model_used, prompt_tokens, completion_tokens).
    """

    def factory() -> BatchScorer:
        call = call_factory()

        def one(prompt: str) -> tuple:
            try:
                values = zip((str, str, int, int), call(prompt), strict=True)
                return (*[None if v is None else kind(v) for kind, v in values], None)
            except Exception as exc:
                return (None, None, None, None, f"{type(exc).__name__}: {exc}")

        def score(prompts: pd.Series) -> pd.DataFrame:
            columns = ["raw_response", "model_used", "prompt_tokens", "completion_tokens", "scorer_error"]
            return pd.DataFrame([one(p) for p in prompts], columns=columns, dtype=object)

        return score

    return factory
