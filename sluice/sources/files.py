"""File sources: CSV, Parquet, multi-dataset reads and dataset discovery.

Readers take an explicit ``StructType`` whenever one is known: schema
inference costs an extra pass over the input (two for CSV) and its result
can change from run to run.  All readers are lazy, so column pruning and
predicate pushdown reach the scan.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the timestamp pattern the load step uses for CSV input.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Full-precision pattern for round trips of microsecond timestamps.
CSV_TIMESTAMP_FORMAT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    header: bool = True,
    timestamp_format: str | None = None,
    infer_schema: bool | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header row.  With ``schema=None`` the types are inferred
    (an extra pass); pass a schema in production.  ``timestamp_format`` is
    applied to both zoned and zone-free timestamp columns."""
    reader = spark.read.option("header", str(header).lower())
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true" if infer_schema is None else str(infer_schema).lower())
    for k, v in options.items():
        reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.csv(paths)


def read_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
                 merge_schema: bool = False, base_path: str | None = None, **options: str) -> DataFrame:
    """One or many Parquet datasets (paths may be globs) read as one table.

    Many run folders read together are an implicit ``UNION ALL``;
    ``merge_schema`` reconciles runs whose columns drifted; ``base_path``
    keeps ``key=value`` folder names as partition columns under a glob.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if base_path:
        reader = reader.option("basePath", base_path)
    for k, v in options.items():
        reader = reader.option(k, v)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  on_missing: str = "empty", **options: str) -> DataFrame:
    """Read a dataset; when the path does not exist either raise
    (``on_missing="error"``) or return an empty frame of ``schema``."""
    try:
        df = spark.read.format(fmt).schema(schema).options(**options).load(path)
        df.schema  # resolve now so a missing path surfaces here
        return df
    except AnalysisException as err:
        if on_missing == "error" or "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], schema)


def with_source_file(df: DataFrame, out: str = "source_file", name_only: bool = False) -> DataFrame:
    """Per-row lineage: the file each row was read from (file sources only);
    ``name_only`` keeps the last path segment."""
    path = F.col("_metadata.file_path")
    return df.withColumn(out, F.element_at(F.split(path, "/"), -1) if name_only else path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small literal table (tests, fixtures).  Empty input needs an explicit
    schema: Spark cannot infer types from no rows."""
    return spark.createDataFrame(list(rows), schema)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _gateway_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm  # noqa: B018 - classic PySpark only
        return True
    except Exception:  # Spark Connect: no SparkContext / JVM gateway
        return False


def _listing(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Paths of the files under ``pattern``, listed by a Spark scan (only the
    ``path`` column is selected, so file contents are not read); None if
    nothing matches.  Used where the JVM gateway is unavailable."""
    try:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .load(pattern).select("path"))
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return None
        raise


def qualified_depth(spark: SparkSession, path: str) -> int:
    """How many parts, the empty one before the first slash included, the full path has."""
    if _gateway_available(spark):
        fs, p = _fs(spark, path)
        path = fs.makeQualified(p).toUri().getPath()
    return len(("/" + _bare(path).rstrip("/")).split("/"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for HDFS, S3, local)."""
    if not _gateway_available(spark):
        return _listing(spark, path) is not None
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob_exists(spark: SparkSession, pattern: str) -> bool:
    """True if a path or glob pattern matches at least one entry."""
    if not _gateway_available(spark):
        found = _listing(spark, pattern)
        return found is not None and not found.isEmpty()
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def list_children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is_dir)`` of the entries directly below ``path``."""
    if not _gateway_available(spark):
        return _children_from_listing(path, _listing(spark, path))
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(p)]


def _bare(path: str) -> str:
    """Path without scheme (``file:``, ``hdfs://host``, ...) or leading slashes."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", path).lstrip("/")


def _children_from_listing(root: str, paths: DataFrame | None) -> list[tuple[str, bool]]:
    """First-level entries of ``root`` derived from a recursive file listing
    (folders without visible files do not show up this way).  Only the
    entries' names reach the driver, not the files below them."""
    if paths is None:
        return []
    base = _bare(root).rstrip("/") + "/"
    bare = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    parts = F.filter(F.split(F.substring(bare, len(base) + 1, 1 << 30), "/"), lambda x: x != "")
    found = (paths.where(bare.startswith(base)).select(F.element_at(parts, 1).alias("name"), (F.size(parts) > 1).alias("dir"))
             .groupBy("name").agg(F.max("dir").alias("dir")))
    return sorted((r["name"], r["dir"]) for r in found.collect())


def discover_datasets(spark: SparkSession, root: str, dir_marker: str | None = None,
                      file_pattern: str | None = "*.csv", on_missing: str = "empty") -> dict[str, list[str]]:
    """List a lake folder: dataset directories whose name contains
    ``dir_marker`` (Parquet) and plain files matching ``file_pattern`` (CSV).

    Only names are listed on the driver - never data.  A missing root returns
    nothing (``on_missing="empty"``) or raises (``"error"``).
    """
    if not path_exists(spark, root):
        if on_missing == "error":
            raise FileNotFoundError(root)
        return {"parquet": [], "csv": []}
    base = root.rstrip("/")
    parquet, csv = [], []
    for name, is_dir in sorted(list_children(spark, root)):
        if name.startswith((".", "_")):
            continue
        # Spark writes a CSV "file" as a folder of parts: match on the name.
        if file_pattern and fnmatch.fnmatch(name, file_pattern):
            csv.append(f"{base}/{name}")
        elif is_dir and (dir_marker is None or dir_marker in name):
            parquet.append(f"{base}/{name}")
    return {"parquet": parquet, "csv": csv}
