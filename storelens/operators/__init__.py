"""Reusable DataFrame operators."""

from storelens.operators.aggregates import (
    equal_width_histogram,
    exact_mean,
    rounded_mean,
    share_of_total,
    value_counts,
    weighted_mean,
    weighted_sum,
    with_share,
)
from storelens.operators.quality import (
    default_for,
    ensure_columns,
    has_columns,
    is_empty,
    not_null_violations,
    suite,
    unique_violations,
)
from storelens.operators.rows import distinct_on, exact_sample, expand_rows, top_k

__all__ = [
    "default_for", "distinct_on", "ensure_columns", "equal_width_histogram",
    "exact_mean", "exact_sample", "expand_rows", "has_columns", "is_empty",
    "not_null_violations", "rounded_mean", "share_of_total", "suite", "top_k", "unique_violations", "value_counts",
    "weighted_mean", "weighted_sum", "with_share",
]
