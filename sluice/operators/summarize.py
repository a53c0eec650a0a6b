"""Grouped summaries.

The daily summary is one hash aggregate: a partial aggregate per task, one
exchange on the group key, a final aggregate.  Groups are few (days x bands),
so a key holding a third of all rows is collapsed in the partial step and the
exchange carries one row per task and group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import exact_mean, quoted
from sluice.operators.enrich import timestamp_value
from sluice.schemas import SUMMARY_TS

DAILY_KEYS = ("year", "month", "day", "value_category")


def daily_summary(
    df: DataFrame,
    keys: Sequence[str] = DAILY_KEYS,
    value: str = "value",
    exact_scale: int | None = None,
    as_of: dt.datetime | str | None = None,
    with_timestamp: bool = True,
) -> DataFrame:
    """``record_count``, ``avg_value``, ``min_value``, ``max_value`` per group.

    The average is Spark's ``avg``.  Callers whose values are fixed-point pass
    their number of decimals as ``exact_scale``: the sum is then an exact
    DECIMAL, so the result doesn't depend on how rows were partitioned.
    """
    v = quoted(value)
    avg = exact_mean(v, exact_scale) if exact_scale is not None else F.avg(v)
    out = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).cast("bigint").alias("record_count"),
        avg.cast("double").alias("avg_value"),
        F.min(v).cast("double").alias("min_value"),
        F.max(v).cast("double").alias("max_value"),
    )
    if with_timestamp:
        out = out.withColumn(SUMMARY_TS, timestamp_value(as_of))
    return out


def partial_summary(df: DataFrame, keys: Sequence[str] = DAILY_KEYS, value: str = "value", exact_scale: int | None = None) -> DataFrame:
    """What ``daily_summary`` needs of a part of the rows: counts, sum, minimum and maximum per group.

    Partials of parts merge to the summary of the whole (``merge_summaries``), so a table's summary can be kept up to
    date from its new parts alone.  With ``exact_scale`` the sums are DECIMAL and merging gives the very same averages.
    """
    v = quoted(value)
    total = v.cast(T.DecimalType(18, exact_scale)) if exact_scale is not None else v.cast("double")
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).cast("bigint").alias("record_count"), F.count(v).cast("bigint").alias("value_count"),
        F.sum(total).alias("value_sum"), F.min(v).cast("double").alias("min_value"), F.max(v).cast("double").alias("max_value"),
    )


def merge_summaries(partials: DataFrame, keys: Sequence[str] = DAILY_KEYS, as_of: dt.datetime | str | None = None,
                    with_timestamp: bool = True) -> DataFrame:
    """The daily summary of all rows whose ``partials`` these are."""
    out = partials.groupBy(*[quoted(k) for k in keys]).agg(
        F.sum("record_count").cast("bigint").alias("record_count"),
        F.try_divide(F.sum("value_sum").cast("double"), F.sum("value_count").cast("double")).alias("avg_value"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
    )
    return out.withColumn(SUMMARY_TS, timestamp_value(as_of)) if with_timestamp else out
