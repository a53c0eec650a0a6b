"""File sinks: Parquet (plain, partitioned, per run) and CSV exports.

Writes are idempotent: ``overwrite`` of a folder, or - for partitioned tables -
dynamic partition overwrite, which replaces only the partitions present in the
new data, so re-running a day rewrites that day and nothing else.  Row counts
come from an ``Observation`` attached to the write itself, not from a second
``count()`` job.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluice.sources.files import CSV_TIMESTAMP_FORMAT

# Fixed value: per-run folder suffix ``<base>_%Y%m%d_%H%M%S``.
RUN_ID_FORMAT = "%Y%m%d_%H%M%S"


def run_id(at: dt.datetime | None = None) -> str:
    """One id per run, taken once, so every output of the run shares it.  An id
    of now ends with a random part: two runs within a second stay apart."""
    return at.strftime(RUN_ID_FORMAT) if at else f"{dt.datetime.now().strftime(RUN_ID_FORMAT)}_{uuid.uuid4().hex[:6]}"


def run_output_path(base: str, rid: str) -> str:
    return f"{base}_{rid}"


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled in by whatever action runs next."""
    obs = Observation(f"{name}_{uuid.uuid4().hex}")  # names must be unique per session
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy",
                  partition_by: Sequence[str] | None = None) -> int:
    """Write Parquet and return the number of rows written (from an Observation)."""
    out, obs = observed(df)
    writer = out.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get.get("rows", 0))


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] = ("year", "month"),
                      mode: str = "overwrite", compression: str = "snappy", rebalance: bool = True) -> int:
    """Partitioned Parquet table, one folder per key combination.

    Rows are clustered by the partition keys with a ``REBALANCE`` hint: each
    task writes few folders (no small-file explosion), and AQE splits a key
    that holds a large share of the rows into several tasks and merges tiny
    ones, so one hot month never lands on one writer.  With
    ``mode="overwrite"`` only the partitions present in ``df`` are replaced
    (dynamic partition overwrite).  ``rebalance=False`` skips the shuffle for
    inputs already clustered by the keys (e.g. one landed day).
    """
    out, obs = observed(df.hint("rebalance", *keys) if rebalance else df)
    (out.write.mode(mode).option("compression", compression)
        .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
    return int(obs.get.get("rows", 0))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              single_file: bool = False, timestamp_format: str = CSV_TIMESTAMP_FORMAT) -> int:
    """CSV export with a header.  ``single_file=True`` writes one part file:
    the rows are shuffled into one partition (``repartition(1)``, so the work
    before it stays parallel - ``coalesce(1)`` would run that in one task too);
    meant for small exports.  The default writes one file per task.
    Timestamps use ``timestamp_format`` for both zoned and zone-free columns,
    the same pattern the CSV reader is given."""
    src = df.repartition(1) if single_file else df
    out, obs = observed(src)
    (out.write.mode(mode).option("header", str(header).lower())
        .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
        .csv(path))
    return int(obs.get.get("rows", 0))


def write_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, path: str | None = None,
                   sort: bool = True, mode: str = "overwrite") -> int:
    """Save ``df`` as a catalog table hash-bucketed on ``by``.

    Reading it back with ``spark.table(table)`` lets Spark skip the exchange of
    any aggregation or join whose keys include ``by`` (e.g. the full-row
    de-duplication of a table bucketed by ``id``): rows that must meet are
    already in the same bucket file.  ``buckets`` should grow with the table
    (e.g. one bucket per ~256 MB).
    """
    out, obs = observed(df)
    writer = out.write.mode(mode).format("parquet").bucketBy(buckets, *by)
    if sort:
        writer = writer.sortBy(*by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return int(obs.get.get("rows", 0))
