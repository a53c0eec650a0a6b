"""Profiling and data-quality operators.

All profiles are single aggregation jobs.  Per-column statistics are computed
in one wide ``agg`` and reshaped with ``unpivot`` (never one job per column).
The duplicate profile groups by every column once: the partial aggregate
before the exchange collapses copies map-side, and the second, global
aggregate reduces the per-group counts to one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import exact_mean, exact_stddev, is_missing, quoted


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` the smallest ``n`` by those
    columns (deterministic; planned as a bounded top-k per task)."""
    return (df.orderBy(*[quoted(c) for c in order_by]) if order_by else df).limit(n)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one BIGINT per column: how many NULLs it holds."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[_count_if(quoted(c).isNull()).alias(c) for c in cols])


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing_count, missing_pct)`` per column, where missing
    means NULL or NaN.  ``missing_pct`` is a percentage of all rows."""
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[_count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)],
    )
    long = wide.select(
        "__total",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"__m{i}").alias("missing_count"))
            for i, c in enumerate(cols)
        ])).alias("m"),
    )
    return long.select(
        "m.column_name",
        "m.missing_count",
        F.try_divide(F.col("m.missing_count") * 100.0, F.col("__total")).alias("missing_pct"),
    )


def group_counts(df: DataFrame, column: str, count_name: str = "count") -> DataFrame:
    """Rows per value of ``column`` (label distribution)."""
    return df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias(count_name))


def describe(df: DataFrame, columns: Sequence[str], exact_scale: int | None = None) -> DataFrame:
    """Typed summary statistics, one row per column:
    ``(column_name, count, mean, stddev, min, max)``.

    ``exact_scale=None`` uses Spark's ``avg``/``stddev_samp``.  For fixed-point
    data (money with two decimals) ``exact_scale=2`` sums as DECIMAL, making
    mean and stddev independent of partitioning and task order.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = quoted(c)
        mean = exact_mean(x, exact_scale) if exact_scale is not None else F.avg(x)
        std = exact_stddev(x, exact_scale) if exact_scale is not None else F.stddev_samp(x)
        aggs.append(F.struct(
            F.lit(c).alias("column_name"),
            F.count(x).cast("bigint").alias("count"),
            mean.cast("double").alias("mean"),
            std.cast("double").alias("stddev"),
            F.min(x).cast("double").alias("min"),
            F.max(x).cast("double").alias("max"),
        ).alias(f"__s{i}"))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(columns))])).alias("s")).select("s.*")


def duplicate_profile(df: DataFrame, columns: Sequence[str] | None = None, approx_rsd: float | None = None) -> DataFrame:
    """``(total_rows, distinct_rows, duplicate_rows, duplicate_pct)`` in one job.

    Exact by default (one group-by over the columns).  ``approx_rsd`` (e.g.
    0.01) switches to a HyperLogLog count of a 64-bit row hash: no row is
    shuffled, only sketches - an estimate, labelled as such by the caller.
    """
    cols = list(columns) if columns is not None else df.columns
    if approx_rsd is not None:
        distinct = F.approx_count_distinct(F.xxhash64(*[quoted(c) for c in cols]), approx_rsd)
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"),
                      distinct.cast("bigint").alias("distinct_rows")).select(
            "total_rows", "distinct_rows",
            (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
            F.try_divide((F.col("total_rows") - F.col("distinct_rows")) * 100.0, F.col("total_rows")).alias("duplicate_pct"),
        )
    groups = df.groupBy(*[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
    ).select(
        "total_rows",
        "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        F.try_divide((F.col("total_rows") - F.col("distinct_rows")) * 100.0, F.col("total_rows")).alias("duplicate_pct"),
    )


def quality_report(df: DataFrame, prefix: str = "missing_", approx_rsd: float | None = None) -> DataFrame:
    """Total rows, distinct rows, duplicates and NULL-or-NaN count per column,
    as one row, from a single aggregation job.

    The group-by over every column keeps each column's value in the group key,
    so the missing count of a column is the sum of group sizes whose key is
    missing there - no second pass over the data.  With ``approx_rsd`` the
    distinct count is a HyperLogLog estimate over a 64-bit row hash and no
    rows are shuffled (for very wide tables); missing counts stay exact.
    """
    cols = df.columns
    if approx_rsd is not None:
        distinct = F.approx_count_distinct(F.xxhash64(*[quoted(c) for c in cols]), approx_rsd)
        return df.agg(
            F.count(F.lit(1)).cast("bigint").alias("total_rows"),
            distinct.cast("bigint").alias("distinct_rows"),
            *[_count_if(is_missing(df, c)).alias(prefix + c) for c in cols],
        ).select(
            "total_rows", "distinct_rows",
            (F.col("total_rows") - F.col("distinct_rows")).alias("duplicates"),
            *[F.col(prefix + c) for c in cols],
        )
    groups = df.groupBy(*[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    missing = [
        F.coalesce(F.sum(F.when(is_missing(df, c), n).otherwise(F.lit(0))), F.lit(0)).cast("bigint").alias(prefix + c)
        for c in cols
    ]
    return groups.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        *missing,
    ).select(
        "total_rows", "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicates"),
        *[F.col(prefix + c) for c in cols],
    )


def quality_report_by(df: DataFrame, key: str, prefix: str = "missing_") -> DataFrame:
    """``quality_report`` for every value of ``key`` (e.g. a dataset id) at
    once: one row per key from a single grouped aggregate, instead of one job
    per key."""
    cols = [c for c in df.columns if c != key]
    groups = df.groupBy(quoted(key), *[quoted(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    missing = [
        F.coalesce(F.sum(F.when(is_missing(df, c), n).otherwise(F.lit(0))), F.lit(0)).cast("bigint").alias(prefix + c)
        for c in cols
    ]
    return groups.groupBy(quoted(key)).agg(
        F.sum(n).cast("bigint").alias("total_rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        *missing,
    ).select(
        quoted(key), "total_rows", "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicates"),
        *[F.col(prefix + c) for c in cols],
    )


def quality_summary(df: DataFrame, table_name: str = "DataFrame", approx_rsd: float | None = None) -> dict:
    """The report as a small dict (one collected row: bounded by column count)."""
    row = quality_report(df, approx_rsd=approx_rsd).first().asDict()
    total = row["total_rows"]
    nulls = {c: row["missing_" + c] for c in df.columns}
    return {
        "table_name": table_name,
        "total_rows": total,
        "distinct_rows": row["distinct_rows"],
        "duplicates": row["duplicates"],
        "duplicate_pct": round(100.0 * row["duplicates"] / total, 2) if total else None,
        "null_counts": nulls,
        "null_pct": {c: (round(100.0 * n / total, 2) if total else None) for c, n in nulls.items()},
    }


def expected_columns_report(df: DataFrame, expected: Iterable[str] | T.StructType) -> DataFrame:
    """``(column_name, present, expected_type, actual_type, type_ok)`` for each
    expected column.  Built from the schema only: no data is read."""
    spark = df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(expected, T.StructType):
        wanted = [(f.name, f.dataType) for f in expected.fields]
    else:
        wanted = [(name, None) for name in expected]
    rows = []
    for name, dtype in wanted:
        got = actual.get(name)
        rows.append((
            name, got is not None,
            dtype.simpleString() if dtype is not None else None,
            got.simpleString() if got is not None else None,
            (got is not None) and (dtype is None or got == dtype),
        ))
    schema = "column_name string, present boolean, expected_type string, actual_type string, type_ok boolean"
    return spark.createDataFrame(rows, schema)


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


def validate_for_load(df: DataFrame, required: Sequence[str] = ("id", "name", "value", "timestamp")) -> bool:
    """Pre-load gate: every required column exists and the frame has a row.
    NULLs in key columns do not fail it (cleaning handles them)."""
    if missing_columns(df, required):
        return False
    return not df.isEmpty()


def ensure_nonempty(df: DataFrame, label: str = "dataset") -> DataFrame:
    """Raise if the frame has no rows (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{label} is empty")
    return df


def frames_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs between the two frames, each once, with
    ``side`` ('left_only' / 'right_only') and ``copies`` (how many more times
    it occurs on that side).  Empty means the frames are equal as multisets.

    Both sides are tagged and grouped once (one exchange, partial aggregation
    first), instead of two ``exceptAll`` passes.  Copies are counted, not
    replicated: a row repeated billions of times stays one output row, never
    one task expanding it.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"column sets differ: {left.columns} vs {right.columns}")
    cols = [quoted(c) for c in left.columns]
    tagged = (left.select(*cols, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
              .unionByName(right.select(*cols, F.lit(0).alias("__l"), F.lit(1).alias("__r"))))
    counts = tagged.groupBy(*cols).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    extra = F.col("__l") - F.col("__r")
    return counts.where(extra != 0).select(
        *cols,
        F.when(extra > 0, F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"),
        F.abs(extra).cast("bigint").alias("copies"),
    )


def frames_equal(left: DataFrame, right: DataFrame, check_schema: bool = True) -> bool:
    if check_schema and left.schema != right.schema:
        return False
    return frames_diff(left, right).isEmpty()


def _same_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of ``left``, in the types that a union of them has: a hash depends on the type."""
    common = left.unionByName(right).schema
    return tuple(side.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in common.fields]) for side in (left, right))


def changed_ranges(left: DataFrame, right: DataFrame, fanout: int = 256, levels: int = 2) -> tuple[Column, list[int]]:
    """Where two frames differ: an expression that gives a row's range, and the ranges whose rows aren't the same.

    Rows are dealt out by hash into ``fanout ** levels`` ranges, a tree with ``fanout`` children a node.  A node's digest
    is the number of its rows and two sums of 64-bit hashes of them, which no order changes, left ones counted for
    and right ones against: all three are zero where the sides have the same rows as often.  Level by level only
    children of unequal nodes are looked at.  What moves between tasks and to the driver is digests, at most one
    a range, never rows.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"column sets differ: {left.columns} vs {right.columns}")
    cols = [quoted(c) for c in left.columns]
    left, right = _same_types(left, right)
    spark, size = left.sparkSession, fanout ** levels
    place = F.pmod(F.xxhash64(*cols), F.lit(size))
    first, second = F.xxhash64(F.lit("first"), *cols), F.xxhash64(F.lit("second"), *cols)
    unequal: list[int] | None = None
    for level in range(1, levels + 1):
        step = fanout ** (levels - level)
        node = F.floor(place / step).alias("__node")
        tagged = None
        for side, sign in ((left, 1), (right, -1)):
            rows = side.select(node, F.lit(sign).alias("__n"), (first.cast("decimal(20,0)") * sign).alias("__a"), (second.cast("decimal(20,0)") * sign).alias("__b"))
            if unequal is not None:
                parents = spark.createDataFrame([(u,) for u in unequal], "__parent bigint")
                rows = rows.withColumn("__parent", F.floor(F.col("__node") / fanout)).join(F.broadcast(parents), "__parent", "left_semi").drop("__parent")
            tagged = rows if tagged is None else tagged.unionByName(rows)
        sums = tagged.groupBy("__node").agg(*[F.sum(c).alias(c) for c in ("__n", "__a", "__b")])
        unequal = sorted(r["__node"] for r in sums.where("__n <> 0 or __a <> 0 or __b <> 0").select("__node").collect())
        if not unequal:
            break
    return place, unequal or []


def frames_diff_by_ranges(left: DataFrame, right: DataFrame, fanout: int = 256, levels: int = 2) -> DataFrame:
    """``frames_diff`` of frames that are mostly alike: only rows of ranges that differ are exchanged, none if none does.

    Both frames are read once for each level, and once more if they differ.
    """
    place, unequal = changed_ranges(left, right, fanout, levels)
    left, right = _same_types(left, right)
    spark = left.sparkSession
    if not unequal:
        return spark.createDataFrame([], T.StructType([*left.schema.fields, T.StructField("side", T.StringType()), T.StructField("copies", T.LongType())]))
    ranges = F.broadcast(spark.createDataFrame([(u,) for u in unequal], "__range bigint"))
    inside = [side.select(*[quoted(c) for c in left.columns]).withColumn("__range", place).join(ranges, "__range", "left_semi").drop("__range") for side in (left, right)]
    return frames_diff(*inside)
