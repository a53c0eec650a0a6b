"""JDBC sinks: append, overwrite (truncate keeps DDL and indexes), and
target-table creation from a ``StructType``.

Each write partition opens its own connection and sends batches of
``batch_size`` rows; ``num_partitions`` caps the concurrent connections.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.sinks.files import observed
from sluice.sources.jdbc import DEFAULT_BATCH, DEFAULT_ISOLATION

log = logging.getLogger("sluice")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "append",
    batch_size: str | int = DEFAULT_BATCH,
    isolation: str = DEFAULT_ISOLATION,
    num_partitions: int | None = None,
    truncate: bool = True,
    column_types: str | None = None,
) -> int:
    """Write ``df`` to ``table``; returns rows written (Observation, no recount).

    ``mode="overwrite"`` truncates instead of dropping when ``truncate`` is set,
    so the table keeps its declared types and indexes.
    """
    # Repartitioning here (a shuffle) keeps the upstream work parallel and
    # caps the writers at ``num_partitions`` connections; letting the JDBC
    # writer coalesce instead would also shrink the upstream stage.
    src = df.repartition(num_partitions) if num_partitions else df
    out, obs = observed(src)
    writer = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", str(batch_size)).option("isolationLevel", isolation))
    if mode == "overwrite" and truncate:
        writer = writer.option("truncate", "true")
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()
    return int(obs.get.get("rows", 0))


def _run_sql(spark: SparkSession, url: str, properties: Mapping[str, str] | None, *statements: str) -> None:
    """Run statements on one connection of the driver, as one transaction."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        info.setProperty(k, v)
    if driver := (properties or {}).get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.executeUpdate(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def append_through_stage(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                         num_partitions: int | None = None) -> int:
    """Append ``df`` to the existing ``table`` all or nothing: parallel writers
    fill a staging table of this load's own, one ``INSERT ... SELECT`` moves its
    rows.  Loads of one table don't meet, and a failed one leaves the target as
    it was; a staging table that its load couldn't drop is named in the log."""
    spark = df.sparkSession
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f'"{c}"' for c in df.columns)
    try:
        rows = write_jdbc(df, url, stage, properties, mode="overwrite", num_partitions=num_partitions, truncate=False)
        _run_sql(spark, url, properties, f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}", f"DROP TABLE {stage}")
    except Exception:
        try:
            _run_sql(spark, url, properties, f"DROP TABLE {stage}")
        except Exception as err:  # it may not have come to be; the load's own failure is what counts
            log.warning("staging table %s not dropped: %s", stage, str(err).splitlines()[0])
        raise
    return rows


def table_exists_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> bool:
    """Whether ``table`` can be selected from; a database that can't be reached is an error, not an absent table."""
    _run_sql(spark, url, properties)
    reader = spark.read.format("jdbc").option("url", url).option("query", f"SELECT * FROM {table} WHERE 1 = 0")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    try:
        reader.load().schema
        return True
    except Exception:
        return False


def create_table_jdbc(spark: SparkSession, url: str, table: str, schema: T.StructType,
                      properties: Mapping[str, str] | None = None, column_types: str | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` through Spark: an empty frame of
    ``schema`` written in ``append`` mode creates the table with Spark's JDBC
    type mapping (``column_types`` overrides it, e.g. ``"name VARCHAR(255)"``)
    and leaves an existing table untouched.  Returns True."""
    if not table_exists_jdbc(spark, url, table, properties):
        write_jdbc(spark.createDataFrame([], schema), url, table, properties, mode="append",
                   column_types=column_types)
    return True
