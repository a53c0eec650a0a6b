"""Cleaning operators: pure ``DataFrame -> DataFrame`` functions.

Each step is a narrow transformation (one ``select`` or ``where``) except the
de-duplication, which is the only shuffle of the cleaning path.  Spark plans
``distinct`` as a partial hash aggregate before the exchange, so a group of
copies - however hot - is collapsed map-side and crosses the network once per
task, not once per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import is_floating, is_missing, lower_trim, numeric_columns, quoted, string_columns
from sluice.schemas import METADATA_COLUMNS


def business_columns(df: DataFrame, exclude: Iterable[str] = METADATA_COLUMNS) -> list[str]:
    """Columns that carry data, i.e. not lineage stamps."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose business columns are all NULL.

    Lineage columns are never NULL, so they are left out of the test by
    default; otherwise a stamped row could never be dropped.
    """
    cols = list(subset) if subset is not None else business_columns(df)
    return df.dropna(how="all", subset=cols) if cols else df


def clean_strings(df: DataFrame, exclude: Iterable[str] = ("timestamp", *METADATA_COLUMNS)) -> DataFrame:
    """Lower-case and trim every string column, in one projection."""
    targets = string_columns(df, exclude)
    if not targets:
        return df
    return df.withColumns({c: lower_trim(quoted(c)) for c in targets})


def filter_positive(df: DataFrame, column: str = "value", nan: str = "drop") -> DataFrame:
    """Keep rows with ``column > 0``.  NULL fails the test; NaN (which Spark
    orders above every number) is dropped unless ``nan="keep"``."""
    cond = quoted(column) > 0
    if nan == "drop" and is_floating(df, column):
        cond = cond & ~F.isnan(quoted(column))
    return df.where(cond)


def filter_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL."""
    return df.dropna(how="any", subset=list(columns)) if columns else df


def filter_missing(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL or (for float/double) NaN."""
    return df.where(is_missing(df, column))


def dedup(df: DataFrame, keys: Sequence[str] | None = None,
          exclude: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """Remove duplicate rows.

    Without ``keys``: full-row distinct over the business columns (lineage
    stamps differ per run and must not make copies look distinct).  A row that
    had copies gets all stamps of one of them: of the one that sorts first by
    its stamps in column order, missing ones last - the one extracted first.
    With ``keys``: one arbitrary row per key.

    Either way it is one aggregate and one exchange; copies collapse before it.
    """
    if keys:
        return df.dropDuplicates(list(keys))
    cols = business_columns(df, exclude)
    if len(cols) == len(df.columns) or not cols:
        return df.distinct()
    stamps = [c for c in df.columns if c not in set(cols)]
    ordered = [x for i, c in enumerate(stamps) for x in (quoted(c).isNull().alias(f"none{i}"), quoted(c).alias(f"stamp{i}"))]
    once = df.groupBy(*[quoted(c) for c in cols]).agg(F.min(F.struct(*ordered)).alias("__stamps"))
    kept = {c: F.col(f"__stamps.stamp{i}") for i, c in enumerate(stamps)}
    return once.select(*[kept[c].alias(c) if c in kept else quoted(c) for c in df.columns])


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL (and NaN in float columns) with a constant per column."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present) if present else df


def fill_numeric(df: DataFrame, columns: Sequence[str] = ("value",), fill: float = 0) -> DataFrame:
    """Fill nulls of the listed columns that are numeric."""
    numeric = set(numeric_columns(df))
    return fill_nulls(df, {c: fill for c in columns if c in numeric})


def clean_rows(
    df: DataFrame,
    value_column: str = "value",
    required_columns: Sequence[str] = (),
    nan: str = "drop",
    exclude: Iterable[str] = ("timestamp", *METADATA_COLUMNS),
    carry: Sequence[str] = (),
) -> DataFrame:
    """What ``clean_records`` does to each row by itself: its steps 1 to 4.  No shuffle, also for streams."""
    carried = set(carry)
    out = drop_all_null(df, [c for c in business_columns(df) if c not in carried])
    out = clean_strings(out, (*exclude, *carry))
    if value_column in out.columns:
        out = filter_positive(out, value_column, nan)
    return filter_not_null(out, [c for c in required_columns if c in out.columns])


def clean_records(
    df: DataFrame,
    value_column: str = "value",
    required_columns: Sequence[str] = (),
    nan: str = "drop",
    exclude: Iterable[str] = ("timestamp", *METADATA_COLUMNS),
    fill: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The cleaning step of the transform job.

    1. drop rows whose business columns are all NULL;
    2. lower/trim strings (not ``timestamp`` or lineage columns);
    3. keep ``value > 0`` when that column exists (drops NULL, negatives, NaN);
    4. optionally require non-NULL columns (``required_columns=["name"]``);
    5. full-row distinct - after the string clean-up, so case and space
       variants collapse;
    6. optional constant fill.

    ``carry`` columns (e.g. a dataset id) ride along untouched: they are left
    out of the all-NULL test and the string clean-up but kept in the
    de-duplication, so copies are removed within each carried key only.
    """
    out = dedup(clean_rows(df, value_column, required_columns, nan, exclude, carry))
    if fill:
        out = fill_nulls(out, fill)
    return out
