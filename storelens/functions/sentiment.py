"""Sentiment label -> score."""

from __future__ import annotations

from storelens.functions.sql import as_column, lit
from storelens.sources.schemas import SENTIMENT_SCORES


def sentiment_score_sql(x: str) -> str:
    """Case-insensitive label -> 1.0 / 0.5 / 0.0; unknown labels -> NULL.
    Scores are doubles (decimal literals would make ``avg`` a decimal)."""
    whens = " ".join(f"WHEN lower({x}) = {lit(label)} THEN {lit(float(score))}"
                     for label, score in SENTIMENT_SCORES)
    return f"CASE {whens} ELSE CAST(NULL AS DOUBLE) END"


sentiment_score = as_column(sentiment_score_sql)
