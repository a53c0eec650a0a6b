"""Enrichment operators: derived and lineage columns, all narrow projections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import VALUE_BAND_DEFAULT, VALUE_BANDS, band, murmur_hash, quoted, sha256_hex, snake_case
from sluice.schemas import PROCESSED_TS, PROCESSING_VERSION

# Fixed value: version label stamped by the transform step.
PROCESSING_VERSION_LABEL = "1.0"


def timestamp_value(as_of: dt.datetime | str | None = None) -> Column:
    """Wall-clock time as TIMESTAMP_NTZ: ``as_of`` when given (reproducible
    runs), else the query's start time in the session zone."""
    if as_of is None:
        return F.localtimestamp()
    text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else str(as_of)
    return F.lit(text).cast("timestamp_ntz")


def stamp_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns, e.g. ``{"source_system": "crm_csv"}``."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def stamp_timestamps(df: DataFrame, names: Sequence[str], as_of: dt.datetime | str | None = None) -> DataFrame:
    """Add timestamp lineage columns (one value per query, not per row)."""
    ts = timestamp_value(as_of)
    return df.withColumns({n: ts for n in names})


def add_date_parts(df: DataFrame, column: str = "timestamp",
                   parts: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """``year``, ``month``, ``day`` (day of month) of a timestamp/date column."""
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    return df.withColumns({p: fns[p](quoted(column)) for p in parts})


def add_band(df: DataFrame, column: str = "value", out: str = "value_category",
             bands: Sequence[tuple[float, str]] = VALUE_BANDS, default: str = VALUE_BAND_DEFAULT) -> DataFrame:
    return df.withColumn(out, band(quoted(column), bands, default))


def add_hash(df: DataFrame, column: str = "name", out: str = "name_hash") -> DataFrame:
    """Murmur3 anonymising hash of one column, as BIGINT."""
    return df.withColumn(out, murmur_hash(quoted(column)))


def anonymize_sha256(df: DataFrame, columns: Sequence[str], suffix: str | None = None) -> DataFrame:
    """Replace (or, with ``suffix``, add) the SHA-256 hex of each column."""
    return df.withColumns({(c + suffix if suffix else c): sha256_hex(quoted(c)) for c in columns})


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake_case (``MonthlyCharges`` -> ``monthly_charges``)."""
    names = [snake_case(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"standardised names collide: {names}")
    return df.toDF(*names)


def enrich_records(
    df: DataFrame,
    as_of: dt.datetime | str | None = None,
    version: str = PROCESSING_VERSION_LABEL,
    with_hash: bool = True,
    timestamp_column: str = "timestamp",
    value_column: str = "value",
    name_column: str = "name",
) -> DataFrame:
    """The enrichment step of the transform job, as one projection:

    lineage (``processed_timestamp``, ``processing_version``); date parts when
    the timestamp column exists; ``value_category`` when the value column
    exists; ``name_hash`` when both name and value exist.
    """
    cols = set(df.columns)
    new: dict[str, Column] = {PROCESSED_TS: timestamp_value(as_of), PROCESSING_VERSION: F.lit(version)}
    if timestamp_column in cols:
        ts = quoted(timestamp_column)
        new.update(year=F.year(ts), month=F.month(ts), day=F.dayofmonth(ts))
    if value_column in cols:
        new["value_category"] = band(quoted(value_column))
        if with_hash and name_column in cols:
            new["name_hash"] = murmur_hash(quoted(name_column))
    return df.withColumns(new)
