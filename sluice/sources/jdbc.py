"""JDBC source.

A plain ``read.jdbc`` of a table runs in one task.  ``read_jdbc`` splits the
read into ``num_partitions`` range queries on a numeric, date or timestamp
column, taking the bounds from one ``min/max`` query that the database
answers (not a scan through Spark).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Connection defaults of the target and the source database (overridable by env).
DEFAULT_HOST = "localhost"
TARGET_DEFAULTS = {"port": "5433", "db": "elt_db", "user": "elt_user", "password": ""}
SOURCE_PREFIX = "SOURCE_DB"
SOURCE_DEFAULTS = {"port": "5432", "db": "source_db", "user": "postgres", "password": "password"}
DEFAULT_BATCH = "10000"
DEFAULT_ISOLATION = "READ_COMMITTED"


def jdbc_config_from_env(prefix: str = "POSTGRES") -> dict:
    """``{"url": ..., "properties": {...}}`` for PostgreSQL from ``<PREFIX>_*``
    variables (HOST, PORT, USER, PASSWORD; the database is DB, or NAME for the
    source database).  The target and the source have defaults of their own."""
    known = SOURCE_DEFAULTS if prefix == SOURCE_PREFIX else TARGET_DEFAULTS
    name = "NAME" if prefix == SOURCE_PREFIX else "DB"
    host = os.getenv(f"{prefix}_HOST", DEFAULT_HOST)
    port = os.getenv(f"{prefix}_PORT", known["port"])
    db = os.getenv(f"{prefix}_{name}", known["db"])
    props = {
        "user": os.getenv(f"{prefix}_USER", known["user"]),
        "password": os.getenv(f"{prefix}_PASSWORD", known["password"]),
        "driver": "org.postgresql.Driver",
    }
    if prefix != SOURCE_PREFIX:
        props["stringtype"] = "unspecified"
    return {"url": f"jdbc:postgresql://{host}:{port}/{db}", "properties": props}


def modulo_predicates(column: str, n: int) -> list[str]:
    """``n`` WHERE clauses on the non-negative remainder of ``column`` by ``n`` that
    together cover every row with a non-NULL integer ``column`` exactly once,
    negative ones too, plus one clause for NULLs.  Each
    task gets ~1/n of the rows whatever the key's distribution (range splits
    follow the key space and leave a hot range on one task)."""
    ref = column if column.startswith('"') else f'"{column}"'
    return [f"MOD(MOD({ref}, {n}) + {n}, {n}) = {k}" for k in range(n)] + [f"{ref} IS NULL"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int = 8,
    bounds: tuple | None = None,
    fetch_size: int = 10000,
    predicates: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read a table (or ``(subquery) alias``).  With ``partition_column`` the
    read is split into ``num_partitions`` parallel range queries; with
    ``predicates`` one query per WHERE clause (they must not overlap).
    Filters and projections on the result are pushed into those queries."""
    props = dict(properties or {})
    if predicates:
        conn = {**props, **options, "fetchsize": str(fetch_size)}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=conn)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetch_size))
    for k, v in {**props, **options}.items():
        reader = reader.option(k, v)
    if partition_column:
        lo, hi = bounds if bounds is not None else jdbc_bounds(spark, url, table, partition_column, props)
        if lo is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lo)).option("upperBound", str(hi))
                      .option("numPartitions", str(num_partitions)))
    return reader.load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str,
                properties: Mapping[str, str] | None = None) -> tuple:
    """``(min, max)`` of ``column``, computed by the database.  The column is
    double-quoted (ANSI), as Spark quotes the columns it creates."""
    ref = column if column.startswith('"') else f'"{column}"'
    query = f"(SELECT MIN({ref}) AS lo, MAX({ref}) AS hi FROM {table}) bounds"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    row = reader.load().first()
    return (row[0], row[1]) if row is not None else (None, None)
