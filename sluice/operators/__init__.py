"""DataFrame -> DataFrame operators."""

from sluice.operators.clean import (
    business_columns, clean_records, clean_strings, dedup, drop_all_null, fill_nulls, fill_numeric,
    filter_missing, filter_not_null, filter_positive,
)
from sluice.operators.conform import conform_to_schema, create_target_table
from sluice.operators.enrich import (
    add_band, add_date_parts, add_hash, anonymize_sha256, enrich_records, stamp_literals, stamp_timestamps,
    standardize_columns, timestamp_value,
)
from sluice.operators.quality import (
    describe, duplicate_profile, ensure_nonempty, expected_columns_report, frames_diff, frames_equal,
    group_counts, missing_columns, missing_profile, null_counts, quality_report, quality_report_by, quality_summary,
    row_count, sample_rows,
    validate_for_load,
)
from sluice.operators.impute import exact_quantile, mode_value  # impute(): sluice.operators.impute.impute
from sluice.operators.summarize import daily_summary

__all__ = [n for n in dir() if not n.startswith("_")]
