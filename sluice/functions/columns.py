"""Column-expression builders.

Everything here returns a ``Column`` (or a list of names picked from a schema),
so operators assemble one flat ``select`` and stay inside whole-stage codegen.
No Python UDFs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)

# Value bands of the enrichment step (upper bound exclusive,
# label); everything else - including NULL and NaN - is "high".
VALUE_BANDS = ((100, "low"), (200, "medium"))
VALUE_BAND_DEFAULT = "high"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """Reference a column whose name may hold dots or spaces."""
    return F.col(f"`{name}`")


def columns_by_type(df: DataFrame, types: tuple[type, ...], exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    return columns_by_type(df, (T.StringType,), exclude)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """All numeric columns: byte through long, float, double and decimal."""
    return columns_by_type(df, (T.NumericType,), exclude)


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FLOATING)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double columns (``isnan`` is never applied to
    other types, which fails under ANSI or for timestamps)."""
    c = quoted(name)
    return (c.isNull() | F.isnan(c)) if is_floating(df, name) else c.isNull()


def lower_trim(c: str | Column) -> Column:
    """Lower-case, then strip leading/trailing spaces (spaces only)."""
    return F.trim(F.lower(col_of(c)))


def band(c: str | Column, bands: Sequence[tuple[float, str]] = VALUE_BANDS,
         default: str = VALUE_BAND_DEFAULT) -> Column:
    """``CASE WHEN c < b1 THEN l1 WHEN c < b2 THEN l2 ... ELSE default END``."""
    c = col_of(c)
    expr = None
    for bound, label in bands:
        expr = F.when(c < F.lit(bound), F.lit(label)) if expr is None else expr.when(c < F.lit(bound), F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def murmur_hash(*cols: str | Column) -> Column:
    """Spark's 32-bit Murmur3 ``hash`` widened to BIGINT (target column type)."""
    return F.hash(*[col_of(c) for c in cols]).cast("bigint")


def sha256_hex(c: str | Column) -> Column:
    """Hex SHA-256 of the value's string form; NULL stays NULL."""
    return F.sha2(col_of(c).cast("string"), 256)


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 (32 bytes) of the row's ``columns``, equal where ``DISTINCT`` sees copies: each value with its length,
    NULL apart from any text, negative zero as zero."""
    parts = []
    for c in columns:
        v = quoted(c)
        text = (F.when(v == 0, F.lit(0.0)).otherwise(v) if is_floating(df, c) else v).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum as DECIMAL so the total is exact and independent of partitioning
    and task order; returned as double."""
    return F.sum(col_of(c).cast(T.DecimalType(18, scale))).cast("double")


def exact_mean(c: str | Column, scale: int = 2) -> Column:
    """Exact decimal sum divided once by the non-null count."""
    c = col_of(c)
    return F.try_divide(exact_sum(c, scale), F.count(c).cast("double"))


def exact_stddev(c: str | Column, scale: int = 2) -> Column:
    """Sample standard deviation from exact decimal sums of x and x*x."""
    d = col_of(c).cast(T.DecimalType(18, scale))
    s = F.sum(d).cast("double")
    q = F.sum(d * d).cast("double")
    n = F.count(d).cast("double")
    return F.when(n > 1, F.sqrt((q - s * s / n) / (n - 1)))


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
_NON_WORD = re.compile(r"[^0-9a-zA-Z]+")


def snake_case(name: str) -> str:
    """``MonthlyCharges`` -> ``monthly_charges``; ``Customer ID`` -> ``customer_id``."""
    spaced = _CAMEL.sub("_", name.strip())
    return _NON_WORD.sub("_", spaced).strip("_").lower()
