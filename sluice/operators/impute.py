"""Imputation of missing values (NULL, or NaN in float columns).

Statistics are computed by distributed jobs and only their (scalar) results
reach the driver:

* ``mean``  - one aggregate for all mean columns;
* ``mode``  - ``groupBy(value).count()`` then the top row (partial aggregation
  collapses a hot value map-side);
* ``median`` - exact, by rank selection: approximate quantiles bracket the
  wanted rank, exact counts confirm the bracket, and the bracket shrinks until
  it holds the wanted value; no values are gathered on the driver.  Spark's
  own ``median`` keeps every distinct value of the column in one aggregation
  buffer, which does not scale to a whole table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import exact_mean, is_missing, quoted

APPROX_ACCURACY = 100_000


def _present_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_missing(df, column)).select(quoted(column).alias("v"))


def kth_smallest(values: DataFrame, rank: int, accuracy: int = APPROX_ACCURACY):
    """Exact value at 0-based ``rank`` of column ``v``.

    Approximate quantiles around the rank are checked by counting; the window
    between the nearest ones below and above is searched next.  Once it holds
    fewer rows than ``accuracy`` the quantiles are exact, so the search ends.
    Only single values and counts reach the driver.
    """
    v = F.col("v")
    lo = hi = None  # open bounds of the window
    below = 0       # rows of smaller value than the window
    eps = 3.0 / accuracy
    while True:
        window = values
        if lo is not None:
            window = window.where(v > F.lit(lo))
        if hi is not None:
            window = window.where(v < F.lit(hi))
        t, size = rank - below, window.count()
        f = (t + 0.5) / size
        tries = window.agg(F.percentile_approx(v, [max(0.0, f - eps), f, min(1.0, f + eps)], accuracy)).first()[0]
        counts = window.agg(*[c for q in tries for c in (F.count_if(v < F.lit(q)), F.count_if(v <= F.lit(q)))]).first()
        passed = 0  # rows of the window that the new lower bound leaves below
        for q, smaller, upto in zip(tries, counts[::2], counts[1::2], strict=True):
            if smaller <= t < upto:
                return q
            if upto <= t:
                lo, passed = max(lo, q) if passed else q, max(passed, upto)
            else:
                hi = min(hi, q) if hi is not None else q
        below += passed


def exact_quantile(df: DataFrame, column: str, q: float = 0.5, accuracy: int = APPROX_ACCURACY):
    """Exact quantile with linear interpolation between the two neighbouring
    ranks (position ``q * (n - 1)``), as ``percentile``/``median`` define it."""
    values = _present_values(df, column)
    n = values.count()
    if n == 0:
        return None
    pos = q * (n - 1)
    lower, upper = math.floor(pos), math.ceil(pos)
    a = kth_smallest(values, lower, accuracy)
    if upper == lower:
        return float(a)
    b = kth_smallest(values, upper, accuracy)
    d = pos - lower
    return (1.0 - d) * float(a) + d * float(b)


def mode_value(df: DataFrame, column: str):
    """Most frequent present value; ties go to the smallest value."""
    top = (_present_values(df, column).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), F.col("v").asc()).limit(1).collect())
    return top[0]["v"] if top else None


def impute(df: DataFrame, strategies: Mapping[str, str | tuple], exact_scale: int | None = None) -> DataFrame:
    """Fill missing values per column: ``"mean"``, ``"median"``, ``"mode"`` or
    ``("constant", value)``.  ``exact_scale`` makes the mean an exact DECIMAL
    sum (fixed-point data)."""
    fills: dict[str, object] = {}
    means = [c for c, s in strategies.items() if s == "mean"]
    if means:
        aggs = [(exact_mean(quoted(c), exact_scale) if exact_scale is not None else F.avg(quoted(c))).alias(c)
                for c in means]
        row = df.select(
            *[F.when(~is_missing(df, c), quoted(c)).alias(c) for c in means]).agg(*aggs).first()
        fills.update({c: row[c] for c in means})
    for c, s in strategies.items():
        if s == "median":
            fills[c] = exact_quantile(df, c, 0.5)
        elif s == "mode":
            fills[c] = mode_value(df, c)
        elif isinstance(s, tuple) and s and s[0] == "constant":
            fills[c] = s[1]
        elif s != "mean":
            raise ValueError(f"unknown strategy for {c}: {s!r}")
    out = {}
    for c, v in fills.items():
        if v is None:
            continue
        dtype = df.schema[c].dataType
        out[c] = F.when(is_missing(df, c), F.lit(v).cast(dtype)).otherwise(quoted(c))
    return df.withColumns(out) if out else df


__all__ = ["exact_quantile", "impute", "kth_smallest", "mode_value"]
