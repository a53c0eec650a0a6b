"""Fit a frame to a declared target table, and catalog table creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted


def conform_to_schema(df: DataFrame, schema: T.StructType, extra: str = "error", cast: str = "cast") -> DataFrame:
    """Return ``df`` with exactly the target's columns, in the target's order
    and types.  Missing columns become typed NULLs; extra columns are rejected,
    or dropped if ``extra="drop"`` says so.  ``cast="try"`` turns
    values that do not convert into NULL instead of failing (ANSI mode)."""
    have = set(df.columns)
    unknown = [c for c in df.columns if c not in set(schema.fieldNames())]
    if unknown and extra == "error":
        raise ValueError(f"columns not in target: {unknown}")
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = quoted(f.name)
            src = df.schema[f.name].dataType
            if src != f.dataType:
                c = c.try_cast(f.dataType) if cast == "try" else c.cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def create_target_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                        partition_by: tuple[str, ...] = (), fmt: str = "parquet") -> bool:
    """``CREATE TABLE IF NOT EXISTS`` in the session catalog.  Returns True
    whether the table was created or already existed."""
    if spark.catalog.tableExists(name):
        return True
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}"
    if partition_by:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{p}`" for p in partition_by) + ")"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return True
