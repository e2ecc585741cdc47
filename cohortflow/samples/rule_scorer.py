"""A deterministic scorer for tests and sample queries; real runs bring their own."""

from __future__ import annotations

import pandas as pd

from cohortflow.operators.scoring import BatchScorer

# Labels by score, 1 to 5.
RISK_LABELS = ["LOW", "MODERATE", "HIGH", "VERY HIGH", "CRITICAL"]


def rule_scorer() -> BatchScorer:
    """Scores 1 plus the number of plain rules the prompt's figures meet."""
    labels = list(RISK_LABELS)

    def above(prompts: pd.Series, pattern: str, limit: float) -> pd.Series:
        figures = prompts.str.extract(pattern, expand=False)
        return (pd.to_numeric(figures, errors="coerce") > limit).astype(int)

    def score(prompts: pd.Series) -> pd.DataFrame:
        conditions = prompts.str.extract(r"Active conditions: (.*)", expand=False)
        met = (
            above(prompts, r"Blood pressure: ([\d.]+)/", 160)
            + above(prompts, r"Glucose: ([\d.]+) mg", 300)
            + above(prompts, r"BMI: ([\d.]+)", 40)
            + (conditions.str.count("; ") >= 2).astype(int)
        )
        raw = met.map(
            lambda n: f'{{"risk_score": {n + 1}, "risk_label": "{labels[n]}", "summary": "{n} of 4 rules met."}}'
        )
        return pd.DataFrame(
            {
                "raw_response": raw,
                "model_used": "rules",
                "prompt_tokens": prompts.str.split().str.len(),
                "completion_tokens": raw.str.split().str.len(),
            }
        )

    return score


def labelled_scorer(label: str) -> BatchScorer:
    """rule_scorer under another model name, which tells whose answers are stored."""
    score = rule_scorer()
    return lambda prompts: score(prompts).assign(model_used=label)
