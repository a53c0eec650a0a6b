"""Reporting-side operators: type cleaning, derived features, per-row quality
scores, dimensions, the churn fact table and churn summaries.

Surrogate keys are SHA-256 hashes of the natural key, so the fact table
derives its keys row by row - no join, no shuffle - and always agrees with
the dimensions built from the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import band, quoted
from sluice.operators.quality import describe, missing_columns
from sluice.sources.derived import SERVICE_COLUMNS

# Fixed values (our choice; the documentation names the feature only):
# tenure bands in months, upper bound exclusive.
TENURE_BANDS = ((12, "0-1y"), (24, "1-2y"), (48, "2-4y"))
TENURE_BAND_DEFAULT = "4y+"
YES_VALUES = ("yes", "true", "1", "y")


def clean_types(df: DataFrame, types: Mapping[str, str], rejects: str = "rejected_fields") -> DataFrame:
    """Convert columns to the given types with ``try_cast``; values that do
    not convert become NULL and are counted per row in ``rejects``."""
    new: dict[str, Column] = {}
    bad = []
    for c, t in types.items():
        raw = quoted(c)
        typed = raw.try_cast(t)
        new[c] = typed
        bad.append(F.when(raw.isNotNull() & typed.isNull(), F.lit(1)).otherwise(F.lit(0)))
    total = bad[0] if bad else F.lit(0)
    for b in bad[1:]:
        total = total + b
    new[rejects] = total.cast("int")
    return df.withColumns(new)


def add_tenure_band(df: DataFrame, column: str = "Tenure", out: str = "TenureBand") -> DataFrame:
    """Band of the tenure; an unknown tenure has no band."""
    known = F.when(quoted(column).isNotNull(), band(quoted(column), TENURE_BANDS, TENURE_BAND_DEFAULT))
    return df.withColumn(out, known)


def is_yes(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin(*YES_VALUES)


def add_service_count(df: DataFrame, columns: Sequence[str] = SERVICE_COLUMNS, out: str = "ServiceCount") -> DataFrame:
    """Number of service flags set ("Yes"/true/1) per row."""
    total = F.lit(0)
    for c in columns:
        total = total + F.when(is_yes(quoted(c)), F.lit(1)).otherwise(F.lit(0))
    return df.withColumn(out, total.cast("int"))


def record_rules() -> dict[str, Column]:
    """Checks of the record shape: keys present, value positive (not NaN)."""
    v = F.col("value")
    return {
        "id_present": F.col("id").isNotNull(),
        "name_present": F.col("name").isNotNull(),
        "value_positive": (v > 0) & ~F.isnan(v),
        "timestamp_present": F.col("timestamp").isNotNull(),
    }


def quality_score(df: DataFrame, rules: Mapping[str, Column], score: str = "quality_score",
                  flag: str = "quality_ok", threshold: float = 1.0) -> DataFrame:
    """Per-row share of rules passed (NULL counts as a failure) and a flag
    that the share reaches ``threshold``."""
    passed = F.lit(0)
    for cond in rules.values():
        passed = passed + F.when(cond, F.lit(1)).otherwise(F.lit(0))
    share = passed / F.lit(float(len(rules)))
    return df.withColumns({score: share, flag: share >= F.lit(threshold)})


def surrogate_key(columns: Sequence[str]) -> Column:
    """Hash of the natural key in a form that no two keys share: each part with
    its length before it, a NULL part as a dash."""
    parts = [quoted(c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def dimension(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Distinct combinations of ``columns`` with a hash surrogate key.  The
    distinct is a partial+final aggregate: the exchange carries at most one
    row per task and combination."""
    return df.select(*[quoted(c) for c in columns]).distinct().withColumn(key, surrogate_key(columns))


def customer_dimension(churn: DataFrame) -> DataFrame:
    """One row per customer (no distinct needed: the churn frame is keyed)."""
    banded = add_tenure_band(churn)
    return banded.select("CustomerID", "Nation", "Region", "TenureBand",
                         surrogate_key(["CustomerID"]).alias("customer_key"))


def churn_fact(churn: DataFrame) -> DataFrame:
    """Measures per customer, keyed to the customer, contract and service
    dimensions by the same hash keys (computed in place, no join)."""
    counted = add_service_count(churn)
    return counted.select(
        surrogate_key(["CustomerID"]).alias("customer_key"),
        surrogate_key(["ContractType"]).alias("contract_key"),
        surrogate_key(list(SERVICE_COLUMNS)).alias("service_key"),
        "Tenure", "MonthlyCharges", "TotalCharges", "ServiceCount",
        F.when(is_yes(F.col("Churn")), F.lit(1)).otherwise(F.lit(0)).alias("churned"),
    )


def churn_fact_joined(churn: DataFrame, customer_dim: DataFrame, contract_dim: DataFrame,
                      service_dim: DataFrame) -> DataFrame:
    """The fact table with keys looked up in existing dimension tables (left
    joins in which NULL equals NULL; a natural key missing from its dimension
    gets a NULL key).  Spark chooses what to broadcast."""
    joined = add_service_count(churn).alias("f")
    for dim, columns, key in ((contract_dim, ["ContractType"], "contract_key"), (service_dim, SERVICE_COLUMNS, "service_key"),
                              (customer_dim, ["CustomerID"], "customer_key")):
        known = dim.select(*[quoted(c).alias(f"__{c}") for c in columns], key)
        on = [quoted(c).eqNullSafe(quoted(f"__{c}")) for c in columns]
        joined = joined.join(known, on, "left").drop(*[f"__{c}" for c in columns])
    return joined.select(
        "customer_key", "contract_key", "service_key",
        "Tenure", "MonthlyCharges", "TotalCharges", "ServiceCount",
        F.when(is_yes(F.col("Churn")), F.lit(1)).otherwise(F.lit(0)).alias("churned"),
    )


def churn_summary(df: DataFrame, dimensions: Sequence[str], label: str = "Churn") -> DataFrame:
    """``(dimension, category, customers, churned, churn_rate)`` for every
    category of every dimension, highest rate first.  ``unpivot`` is a narrow
    expand; the aggregate is partial + final over few groups."""
    long = df.select(*[quoted(c).cast("string").alias(c) for c in dimensions], quoted(label).alias("__label")) \
        .unpivot(["__label"], list(dimensions), "dimension", "category")
    hit = is_yes(F.col("__label"))
    return (long.groupBy("dimension", "category")
            .agg(F.count(F.lit(1)).cast("bigint").alias("customers"),
                 F.count_if(hit).cast("bigint").alias("churned"))
            .withColumn("churn_rate", F.col("churned").cast("double") / F.col("customers"))
            .orderBy(F.col("churn_rate").desc(), "dimension", "category"))


def churn_profile(df: DataFrame, label: str | None, columns: Sequence[str]) -> DataFrame:
    """Long profile ``(metric, key, n)``: the label distribution and the NULL
    count of each column.  Rows are aggregated once, by label; the few groups
    are then summed for the NULL counts.  Without a label, or if the frame
    lacks it, the NULL counts stand alone."""
    known = label is not None and label in df.columns
    key = quoted(label).cast("string") if known else F.lit(None).cast("string")
    keyed = df.select(key.alias("__key"), *[quoted(c).isNull().alias(f"__null{i}") for i, c in enumerate(columns)])
    zeros = [f"__z{i}" for i in range(len(columns))]
    groups = keyed.groupBy("__key").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        *[F.count_if(F.col(f"__null{i}")).cast("bigint").alias(z) for i, z in enumerate(zeros)])
    nulls = groups.agg(*[F.coalesce(F.sum(z), F.lit(0)).cast("bigint").alias(z) for z in zeros]) if zeros else None
    labels = groups.select(F.lit("label").alias("metric"), F.col("__key").alias("key"), "n") if known else None
    if nulls is not None:
        pairs = F.array(*[F.struct(F.lit("null_count").alias("metric"), F.lit(c).alias("key"), F.col(z).alias("n"))
                          for c, z in zip(columns, zeros, strict=True)])
        nulls = nulls.select(F.explode(pairs).alias("m")).select("m.*")
    parts = [p for p in (labels, nulls) if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], "metric string, key string, n bigint")


def validate_churn(df: DataFrame, expected: Sequence[str], label: str | None, numeric: Sequence[str],
                   max_labels: int = 1000) -> dict:
    """The extract's validation as one small dict: expected columns that are
    missing (a warning, never a failure), NULL counts of all columns, the
    label distribution (the ``max_labels`` most frequent values; a label with
    more is no category) and statistics of the numeric columns present."""
    have = set(df.columns)
    result: dict = {"missing_columns": missing_columns(df, expected), "null_counts": {}, "labels": {}, "stats": {}}
    profile = churn_profile(df, label, df.columns)
    result["null_counts"] = {r["key"]: r["n"] for r in profile.where("metric = 'null_count'").collect()}
    if label in have:
        top = profile.where("metric = 'label'").orderBy(F.desc("n"), F.asc("key")).limit(max_labels)
        result["labels"] = {r["key"]: r["n"] for r in top.collect()}
    present = [c for c in numeric if c in have]
    if present:
        result["stats"] = {r["column_name"]: r.asDict() for r in describe(df, present).collect()}
    return result


def file_fingerprints(spark: SparkSession, path: str | Sequence[str], content: bool = True, fmt: str = "parquet") -> DataFrame:
    """``(path, length, modification_time, rows, digest)`` per file of a table.

    The digest is the sum of a 60-bit hash of every row: it does not depend on
    the order of rows, so a file is read by splits and summed with partial
    aggregation, however large it is.  Equal rows in equal numbers give equal
    digests; files without rows are not listed.  With ``content=False`` only
    metadata is read (cheap change detection; rows and digest are NULL).
    """
    if not content:
        files = spark.read.format("binaryFile").load(path)
        return files.select("path", "length", F.col("modificationTime").alias("modification_time"),
                            F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("string").alias("digest"))
    rows = spark.read.format(fmt).load(path)
    row = F.conv(F.substring(surrogate_key(rows.columns), 1, 15), 16, 10).cast("decimal(38,0)")
    meta = F.col("_metadata")
    keyed = rows.select(meta["file_path"].alias("path"), meta["file_size"].alias("length"),
                        meta["file_modification_time"].alias("modification_time"), row.alias("row"))
    return keyed.groupBy("path", "length", "modification_time").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("row").cast("string").alias("digest"))


def unseen_files(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Fingerprints not recorded before (left anti join on the digest)."""
    return current.join(seen.select("rows", "digest").distinct(), on=["rows", "digest"], how="left_anti")
