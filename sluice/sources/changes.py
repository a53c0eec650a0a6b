"""What has changed below a folder of datasets since the last look.

An index keeps each file's fingerprint (``file_fingerprints``): its rows and an
order-free digest of them.  A look lists the files, reads only those whose
length or time of change isn't the index's, and commits the new index in one
step; the index is a snapshot table with a slot a dataset, so that every earlier
look can be compared with any other.

A dataset or file is ``new``, ``removed``, ``changed`` if its rows aren't the
same, and ``unchanged`` if they are, however and whenever they were written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.modeling import file_fingerprints
from sluice.sinks.snapshots import SnapshotTable
from sluice.sources.files import discover_datasets, glob_exists

INDEX_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("file", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()), T.StructField("rows", T.LongType()), T.StructField("digest", T.StringType()),
])


def index_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ("dataset",))


def look(spark: SparkSession, root: str, index_path: str, marker: str | None = None) -> int:
    """Bring the index up to date with the Parquet datasets below ``root``; returns its new version."""
    table = index_table(spark, index_path)
    known = table.read(schema=INDEX_SCHEMA)
    datasets = discover_datasets(spark, root, dir_marker=marker)["parquet"]
    parts = [_fingerprints(spark, path, known) for path in datasets]
    now = reduce(DataFrame.unionByName, [p for p in parts if p is not None], spark.createDataFrame([], INDEX_SCHEMA))
    return table.commit(table.stage(now), drop=lambda slot: True)


def _fingerprints(spark: SparkSession, path: str, known: DataFrame) -> DataFrame | None:
    """The index rows of one dataset: those of files that haven't been touched as they are, those of others from their rows."""
    name, base = path.rstrip("/").rsplit("/", 1)[-1], path.rstrip("/")
    if not glob_exists(spark, f"{base}/*"):
        return None
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
    below = lambda c: F.regexp_extract(c, f"/{_quoted(name)}/(.*)$", 1)
    listed = listed.select(below("path").alias("file"), "path", "length", F.col("modificationTime").alias("modification_time"))
    mine = known.where(F.col("dataset") == name)
    same = listed.drop("path").join(mine, ["file", "length", "modification_time"])
    touched = listed.join(mine.select("file", "length", "modification_time"), ["file", "length", "modification_time"], "left_anti")
    paths = [r["path"] for r in touched.select("path").collect()]  # names of new files, as Spark's own listing has them
    columns = [f.name for f in INDEX_SCHEMA.fields]
    kept = same.select(*columns)
    if not paths:
        return kept
    read = file_fingerprints(spark, paths)
    file = below(F.url_decode(F.regexp_replace("path", "[+]", "%2B"))).alias("file")
    return kept.unionByName(read.select(F.lit(name).alias("dataset"), file, "length", "modification_time", "rows", "digest"))


def _quoted(name: str) -> str:
    """``name`` for a regular expression, each sign of it taken as it is."""
    return "".join(c if c.isalnum() or c in "_" else f"\\{c}" for c in name)


def changes(spark: SparkSession, index_path: str, version: int | None = None, since: int | None = None,
            by: Sequence[str] = ("dataset",)) -> DataFrame:
    """(by..., change, rows, rows_before) between two looks, by default the last and the one before it.

    ``by`` is ("dataset",) or ("dataset", "file"); a dataset whose files were cut anew is unchanged if its rows are.
    """
    table = index_table(spark, index_path)
    version = max(table.versions(), default=0) if version is None else version
    since = max(version - 1, 0) if since is None else since
    total = lambda v: table.read(v, schema=INDEX_SCHEMA).groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum(F.col("digest").cast("decimal(38,0)")).alias("digest"))
    now, before = total(version), total(since).withColumnsRenamed({"rows": "rows_before", "digest": "digest_before"})
    same = (F.col("rows") == F.col("rows_before")) & (F.col("digest") == F.col("digest_before"))
    change = (F.when(F.col("rows_before").isNull(), "new").when(F.col("rows").isNull(), "removed")
              .when(same, "unchanged").otherwise("changed"))
    return now.join(before, list(by), "full").select(*by, change.alias("change"), "rows", "rows_before")
