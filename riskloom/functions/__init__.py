"""Column expressions: everything here is a pure ``Column -> Column`` function."""

from riskloom.functions.columns import (
    as_column,
    clip_column,
    confidence_of,
    cut_column,
    dummy_columns,
    flag_above,
    linear_score_of,
    nan_to_null,
    range_errors,
    range_violation,
    ratio_of,
    recommendation_of,
    risk_category_of,
    safe_divide,
    zero_to_missing,
)

__all__ = [
    "as_column",
    "clip_column",
    "confidence_of",
    "cut_column",
    "dummy_columns",
    "flag_above",
    "linear_score_of",
    "nan_to_null",
    "range_errors",
    "range_violation",
    "ratio_of",
    "recommendation_of",
    "risk_category_of",
    "safe_divide",
    "zero_to_missing",
]
