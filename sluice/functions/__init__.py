"""Scalar column functions (JVM-side expressions only)."""

from sluice.functions.columns import (
    VALUE_BAND_DEFAULT,
    VALUE_BANDS,
    band,
    columns_by_type,
    exact_mean,
    exact_stddev,
    exact_sum,
    is_floating,
    is_missing,
    lower_trim,
    murmur_hash,
    numeric_columns,
    quoted,
    sha256_hex,
    snake_case,
    string_columns,
)

__all__ = [
    "VALUE_BANDS", "VALUE_BAND_DEFAULT", "band", "columns_by_type", "exact_mean", "exact_stddev",
    "exact_sum", "is_floating", "is_missing", "lower_trim", "murmur_hash", "numeric_columns",
    "quoted", "sha256_hex", "snake_case", "string_columns",
]
