"""User-level jobs: extract, transform (API and SQL forms), load, summary and
the end-to-end run.

Every job takes the caller's session and explicit locations, ``run_id`` and
``as_of``, so re-running a day reproduces its outputs; a load adds its run to
the table and replaces only what the same run loaded before.  Stages hand over
through files (Parquet), which also cuts lineage: a lost executor re-reads the
landed files instead of replaying the whole chain.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import VALUE_BAND_DEFAULT, VALUE_BANDS, is_floating
from sluice.operators.clean import clean_records
from sluice.operators.conform import conform_to_schema
from sluice.operators.enrich import enrich_records, timestamp_value
from sluice.operators.modeling import validate_churn
from sluice.operators.quality import quality_report_by, quality_summary
from sluice.operators.seen import distinct_of_sketches, distinct_sketches, drop_seen, filter_words, merge_words
from sluice.operators.summarize import DAILY_KEYS, daily_summary, merge_summaries, partial_summary
from sluice.schemas import (
    CHURN_COLUMNS, CHURN_LABEL, CHURN_NUMERIC, EXTRACTION_TS, LOAD_TS, PROCESSED_SCHEMA, RECORD_SCHEMA, SOURCE_SYSTEM,
)
from sluice.sinks.files import run_id as new_run_id
from sluice.sinks.files import write_csv, write_parquet, write_partitioned
from sluice.sinks.jdbc import append_through_stage, create_table_jdbc, write_jdbc
from sluice.sinks.snapshots import SnapshotTable, refresh, slot_values
from sluice.plans.metrics import RunMetrics, append_by_run, audit_frame, completed_runs
from sluice.sources.files import (
    CSV_TIMESTAMP_FORMAT_MICROS, discover_datasets, glob_exists, path_exists, qualified_depth,
    read_csv, read_parquet,
)
from sluice.sources.jdbc import modulo_predicates, read_jdbc

log = logging.getLogger("sluice")

# Folder-name markers of landed and processed datasets.
RAW_MARKER = "extracted_data"
PROCESSED_PREFIX = "transformed_"


@dataclass
class StepResult:
    rows: int
    path: str
    details: dict = field(default_factory=dict)


def stamp_extraction(df: DataFrame, source_system: str, as_of: dt.datetime | str | None = None) -> DataFrame:
    return df.withColumns({EXTRACTION_TS: timestamp_value(as_of), SOURCE_SYSTEM: F.lit(source_system)})


def extract(
    spark: SparkSession,
    source: DataFrame | str,
    raw_root: str,
    source_system: str,
    rid: str | None = None,
    schema: T.StructType | None = None,
    as_of: dt.datetime | str | None = None,
    export_root: str | None = None,
    expected: Sequence[str] | None = CHURN_COLUMNS,
    label: str | None = CHURN_LABEL,
    numeric: Sequence[str] = CHURN_NUMERIC,
) -> StepResult:
    """Land a source (a DataFrame, or a CSV path read with ``schema``) as
    ``<raw_root>/extracted_data_<source>_<run_id>`` Parquet with lineage columns.

    The landed rows are then profiled against the ``expected`` columns, the
    ``label`` and the ``numeric`` columns: missing columns and NULLs are
    logged and returned, never an error.  ``expected=None`` skips that.

    The optional CSV export is produced from the landed Parquet (a columnar
    re-read), not by parsing the source twice, and goes to ``export_root`` so
    the transform step never mistakes it for a second dataset.
    """
    rid = rid or new_run_id()
    if isinstance(source, str) and not glob_exists(spark, source):
        raise FileNotFoundError(f"input not found: {source}")
    src = source if isinstance(source, DataFrame) else read_csv(
        spark, source, schema=schema, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    name = f"{RAW_MARKER}_{re.sub(r'[^A-Za-z0-9_-]', '_', source_system)}_{rid}"
    out = f"{raw_root.rstrip('/')}/{name}"
    rows = write_parquet(stamp_extraction(src, source_system, as_of), out)
    details = {"run_id": rid}
    if expected is not None:
        landed = spark.read.schema(src.schema).parquet(out)
        details["profile"] = validate_churn(landed, expected, label, numeric)
        if details["profile"]["missing_columns"]:
            log.warning("%s: expected columns missing: %s", name, details["profile"]["missing_columns"])
        log_report(name, {"total_rows": rows, "null_counts": details["profile"]["null_counts"]})
    if export_root:
        csv_path = f"{export_root.rstrip('/')}/{name}.csv"
        write_csv(spark.read.parquet(out), csv_path, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
        details["csv"] = csv_path
    return StepResult(rows, out, details)


def snapshot_source(spark: SparkSession, source: DataFrame | str, raw_root: str, rid: str,
                    schema: T.StructType | None = None) -> StepResult:
    """Back up the source unchanged (no stamps, no cleaning) as
    ``<raw_root>/snapshot_<run_id>`` Parquet."""
    src = source if isinstance(source, DataFrame) else read_csv(
        spark, source, schema=schema, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    out = f"{raw_root.rstrip('/')}/snapshot_{rid}"
    return StepResult(write_parquet(src, out), out)


def extract_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                 partition_column: str | None = None, num_partitions: int = 8) -> DataFrame:
    """Source table read over JDBC in parallel (lazy; nothing is read until an
    action).  ``partition_column`` splits it into ranges; by default the first
    integer column splits it by remainder, which is even however the keys lie."""
    if partition_column is None:
        whole = [f.name for f in read_jdbc(spark, url, table, properties).schema.fields
                 if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))]
        if whole:
            return read_jdbc(spark, url, table, properties, predicates=modulo_predicates(whole[0], num_partitions))
    return read_jdbc(spark, url, table, properties, partition_column=partition_column,
                     num_partitions=num_partitions)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a frame visible to SQL as ``name`` (session-scoped temp view)."""
    df.createOrReplaceTempView(name)
    return df


def log_report(name: str, report: dict) -> None:
    """Warn about duplicates and missing values found by a quality report."""
    total = report.get("total_rows") or 0
    if report.get("duplicates"):
        log.warning("%s: %d duplicate rows of %d", name, report["duplicates"], total)
    nulls = report.get("null_counts") or {c[len("missing_"):]: v for c, v in report.items() if c.startswith("missing_")}
    for column, n in nulls.items():
        if n:
            log.warning("%s: column %s has %d missing values of %d", name, column, n, total)


def transform_dataset(df: DataFrame, as_of: dt.datetime | str | None = None,
                      required_columns: Sequence[str] = (), with_hash: bool = True) -> DataFrame:
    """clean -> enrich for one dataset (lazy)."""
    return enrich_records(clean_records(df, required_columns=required_columns), as_of=as_of, with_hash=with_hash)


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _require_found(only: Sequence[str] | None, found: Sequence[str]) -> None:
    if missing := sorted(set(only or ()) - set(found)):
        raise FileNotFoundError(f"datasets not found: {missing}")


def transform(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    as_of: dt.datetime | str | None = None,
    csv_schema: T.StructType | None = None,
    with_hash: bool = True,
    marker: str = RAW_MARKER,
    export_root: str | None = None,
    report_approx_rsd: float | None = None,
    only: Sequence[str] | None = None,
) -> StepResult:
    """For every landed dataset (Parquet folders named with ``marker``, and
    ``*.csv`` files read with ``csv_schema``, or else with inferred types);
    with ``only``, for the datasets of these names: quality report (one job),
    clean + enrich, write ``<processed_root>/transformed_<name>``.  CSV
    sources also get a CSV copy of their output under ``export_root`` when
    given - outside ``processed_root``, so the load never reads it twice.
    ``report_approx_rsd`` makes the report's distinct count a HyperLogLog
    estimate, sparing very large datasets a second full shuffle.

    Datasets are listed by name on the driver; each one is a distributed job.
    """
    found = discover_datasets(spark, raw_root, dir_marker=marker, file_pattern="*.csv")
    total, reports, stems = 0, {}, set()
    inputs = [(p, kind) for kind in ("parquet", "csv") for p in found[kind] if only is None or _name(p) in only]
    _require_found(only, [_name(p) for p, _ in inputs])
    for path, kind in inputs:
        name = _name(path)
        if kind == "parquet":
            df = read_parquet(spark, path)
        else:  # without a schema the timestamps' own form decides, not a fixed pattern
            df = read_csv(spark, path, schema=csv_schema, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS if csv_schema else None)
        reports[name] = quality_summary(df, name, approx_rsd=report_approx_rsd)
        log_report(name, reports[name])
        stem = name[:-4] if name.endswith(".csv") else name
        if stem in stems:  # a Parquet folder and a CSV file of the same name
            stem += "_csv"
        stems.add(stem)
        out = f"{processed_root.rstrip('/')}/{PROCESSED_PREFIX}{stem}"
        total += write_parquet(transform_dataset(df, as_of, with_hash=with_hash), out)
        if export_root and kind == "csv":
            write_csv(spark.read.parquet(out), f"{export_root.rstrip('/')}/{PROCESSED_PREFIX}{stem}.csv",
                      timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    return StepResult(total, processed_root, {"reports": reports})


DATASET_COLUMN = "dataset"


def tagged_datasets(spark: SparkSession, raw_root: str, names: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The landed Parquet datasets ``names`` as one frame, each row with its dataset.

    The dataset is the folder directly below ``raw_root``, whatever folders
    it holds or lies in.
    """
    root = raw_root.rstrip("/")
    raw = read_parquet(spark, [f"{root}/{n}" for n in names], schema=schema, base_path=root)
    path = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return raw.withColumn(DATASET_COLUMN, F.split(path, "/")[qualified_depth(spark, root)])


def transform_batched(
    spark: SparkSession,
    raw_root: str,
    processed_path: str,
    as_of: dt.datetime | str | None = None,
    with_hash: bool = True,
    marker: str = RAW_MARKER,
    schema: T.StructType | None = None,
    only: Sequence[str] | None = None,
) -> StepResult:
    """The transform over the landed Parquet datasets (all, or those named by ``only``) in one pass.

    They are read by one scan; each row is tagged with its dataset.  The
    per-dataset quality reports come from one grouped aggregate, cleaning
    de-duplicates within each dataset, and the output is written to
    ``<processed_path>/dataset=<name>`` partitions (rebalanced, dynamic
    overwrite).  The number of jobs does not grow with the number of
    datasets, unlike a loop over them.  Datasets must share one schema
    (``schema`` pins it; otherwise Parquet footers decide).  Landed CSV files
    are an error unless ``only`` leaves them out: they need ``transform``.
    """
    found = discover_datasets(spark, raw_root, dir_marker=marker, file_pattern="*.csv")
    names = [_name(p) for p in found["parquet"] if only is None or _name(p) in only]
    if csv := [p for p in found["csv"] if only is None or _name(p) in only]:
        raise ValueError(f"CSV datasets need transform(): {csv}")
    _require_found(only, names)
    if not names:
        return StepResult(0, processed_path, {"reports": {}})
    tagged = tagged_datasets(spark, raw_root, names, schema)
    reports = {r[DATASET_COLUMN]: r.asDict() for r in quality_report_by(tagged, DATASET_COLUMN).collect()}
    for name, report in reports.items():
        log_report(name, report)
    cleaned = clean_records(tagged, carry=(DATASET_COLUMN,))
    out = enrich_records(cleaned, as_of=as_of, with_hash=with_hash)
    rows = write_partitioned(out, processed_path, keys=(DATASET_COLUMN,))
    return StepResult(rows, processed_path, {"reports": reports})


TRANSFORM_SQL = """
SELECT
    id,
    LOWER(TRIM(name)) AS name,
    value,
    `timestamp`,
    {processed_ts} AS processed_timestamp,
    YEAR(`timestamp`) AS year,
    MONTH(`timestamp`) AS month,
    CASE {bands} ELSE '{other}' END AS value_category{hash_column}
FROM {{raw}}
WHERE value > 0 AND name IS NOT NULL{nan_guard}
"""


def transform_sql(raw: DataFrame, as_of: dt.datetime | str | None = None, with_hash: bool = True) -> DataFrame:
    """The SQL form of the transform: one statement, no de-duplication, no
    ``day``, NULL names dropped, hash of the *raw* name.  NaN values are
    dropped like in the API form."""
    spark = raw.sparkSession
    ts = "LOCALTIMESTAMP()" if as_of is None else "CAST(:as_of AS TIMESTAMP_NTZ)"
    text = TRANSFORM_SQL.format(
        processed_ts=ts,
        bands=" ".join(f"WHEN value < {bound} THEN '{label}'" for bound, label in VALUE_BANDS),
        other=VALUE_BAND_DEFAULT,
        hash_column=",\n    CAST(HASH(name) AS BIGINT) AS name_hash" if with_hash else "",
        nan_guard=" AND NOT isnan(value)" if is_floating(raw, "value") else "",
    )
    args = {} if as_of is None else {"as_of": as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else str(as_of)}
    return spark.sql(text, args=args, raw=raw)


RUN_COLUMN = "run_id"


def run_table(spark: SparkSession, target_path: str) -> SnapshotTable:
    """The loaded table at a path: one slot a run."""
    return SnapshotTable(spark, target_path, (RUN_COLUMN,))


def read_table(spark: SparkSession, target_path: str, version: int | None = None, rid: str | None = None) -> DataFrame:
    """The loaded table, all runs or one, as its last version (or ``version``) has it."""
    table = run_table(spark, target_path)
    return table.read(version, None if rid is None else _slots_of(table, rid, version))


def _slots_of(table: SnapshotTable, rid: str, version: int | None = None) -> list[str]:
    return [s for s in table.manifest(version).slots if slot_values(s)[RUN_COLUMN] == rid]


def load(
    spark: SparkSession,
    source: DataFrame | Sequence[str],
    target_path: str,
    as_of: dt.datetime | str | None = None,
    schema: T.StructType = PROCESSED_SCHEMA,
    partition_by: Sequence[str] = ("year", "month"),
    merge_schema: bool = False,
    rid: str | None = None,
    skip_loaded: Sequence[str] | None = None,
) -> StepResult:
    """Add processed rows to the target table, conformed to its columns.

    The table keeps runs apart, and each run by ``partition_by``.  A run adds
    to whatever other runs have loaded, also of the same month; loading it
    again replaces its own rows and nothing else.  Either happens in one step
    when all files are written: readers (``read_table``) see the table as it
    was or as it is, and a load that dies changes nothing.

    ``skip_loaded`` names columns by which rows that another run has loaded
    already are left out.  Only rows that may be among them, by the Bloom
    filters kept of each run, are compared with the table.

    Processed datasets share one schema, so footers are not merged by default
    (merging reads every file footer - a full job on a large lake); pass
    ``merge_schema=True`` when inputs from different versions are mixed."""
    rid = rid or new_run_id()
    if not isinstance(source, DataFrame):
        paths = [p for p in source if glob_exists(spark, p)]
        if not paths:
            log.warning("nothing to load: no processed data at %s", list(source))
            return StepResult(0, target_path, {"skipped": True, "run_id": rid})
        source = read_parquet(spark, paths, merge_schema=merge_schema)
    table = run_table(spark, target_path)
    stamped = source.drop(DATASET_COLUMN).withColumn(LOAD_TS, timestamp_value(as_of))
    rows = conform_to_schema(stamped, schema)
    if skip_loaded:
        rows = without_loaded(table, rows, rid, skip_loaded)
    staged = table.stage(rows.withColumn(RUN_COLUMN, F.lit(rid)), partition_by)
    version = table.commit(staged, drop=lambda slot: slot_values(slot)[RUN_COLUMN] == rid)
    return StepResult(staged.rows, target_path, {"skipped": False, "run_id": rid, "version": version})


def without_loaded(table: SnapshotTable, rows: DataFrame, rid: str, columns: Sequence[str]) -> DataFrame:
    """``rows`` without those whose ``columns`` another run than ``rid`` has loaded (NULL equals NULL)."""
    filters = SnapshotTable(table.spark, f"{table.path}_filters", table.keys)
    refresh(table, filters, lambda df: filter_words(df, columns, by=table.keys))
    others = [s for s in table.manifest().slots if slot_values(s)[RUN_COLUMN] != rid]
    if not others:
        return rows
    return drop_seen(rows, table.read(slots=others), merge_words(filters.read(slots=others)), columns)


def verify_load(spark: SparkSession, target_path: str, expected_rows: int | None = None, rid: str | None = None) -> int:
    """Count what the run ``rid`` (or else everyone) loaded; no rows, or another number than expected, is an error."""
    slots = run_table(spark, target_path).manifest().slots
    n = read_table(spark, target_path, rid=rid).count() if slots else 0
    if n == 0 or (expected_rows is not None and n != expected_rows):
        raise ValueError(f"load verification failed: {n} rows in {target_path}, expected {expected_rows}")
    return n


def loaded_counts(spark: SparkSession, target_path: str) -> DataFrame:
    """(run_id, verified): the rows that each run has in the table, counted in its files."""
    return read_table(spark, target_path).groupBy(RUN_COLUMN).agg(F.count(F.lit(1)).alias("verified"))


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
              as_of: dt.datetime | str | None = None, schema: T.StructType = PROCESSED_SCHEMA,
              num_partitions: int = 4, rid: str | None = None, audit_path: str | None = None) -> StepResult:
    """Append conformed rows to a relational table, ``num_partitions`` writers
    in batches (the relational edge of the load).

    The table is created if it is missing.  The writers fill a staging table,
    whose rows then enter the target in one transaction: a load that fails
    leaves nothing behind, so it can be repeated.  With ``rid`` and
    ``audit_path`` a run that already loaded is skipped, and a successful load
    records its audit row.
    """
    spark = df.sparkSession
    if rid and audit_path and path_exists(spark, audit_path):
        done = completed_runs(spark, audit_path).where(F.col("run_id") == rid)
        if not done.isEmpty():
            return StepResult(0, table, {"skipped": True, "run_id": rid})
    started = dt.datetime.now()
    conformed = conform_to_schema(df.drop(DATASET_COLUMN).withColumn(LOAD_TS, timestamp_value(as_of)), schema)
    create_table_jdbc(spark, url, table, schema, properties)
    rows = append_through_stage(conformed, url, table, properties, num_partitions=num_partitions)
    if rid and audit_path:
        append_by_run(audit_frame(spark, rid, "processed", table, rows, started, dt.datetime.now()), audit_path)
    return StepResult(rows, table, {"skipped": False, "run_id": rid})


def verify_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                expected_rows: int | None = None) -> int:
    """``SELECT COUNT(*)`` answered by the database; zero, or another number than expected, is an error."""
    query = f"(SELECT COUNT(*) AS n FROM {table}) c"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    n = int(reader.load().first()[0])
    if n == 0 or (expected_rows is not None and n != expected_rows):
        raise ValueError(f"load verification failed: {n} rows in {table}, expected {expected_rows}")
    return n


def summarize_jdbc(spark: SparkSession, url: str, source_table: str, summary_table: str,
                   properties: dict | None = None, as_of: dt.datetime | str | None = None,
                   partition_column: str | None = "id", num_partitions: int = 8) -> StepResult:
    """Daily summary of a relational table, replacing the summary table's rows
    (truncate keeps its DDL).  The source is read in parallel ranges."""
    src = read_jdbc(spark, url, source_table, properties, partition_column=partition_column,
                    num_partitions=num_partitions)
    rows = write_jdbc(daily_summary(src, as_of=as_of), url, summary_table, properties, mode="overwrite")
    return StepResult(rows, summary_table)


def refresh_summary(spark: SparkSession, table_path: str, partials_path: str, exact_scale: int | None = None) -> list[str]:
    """Keep the runs' partial summaries up to date: only runs loaded since the last time are read.  Returns these."""
    keys = (RUN_COLUMN, *DAILY_KEYS)
    table, partials = run_table(spark, table_path), SnapshotTable(spark, partials_path, (RUN_COLUMN,))
    return refresh(table, partials, lambda df: partial_summary(df, keys, exact_scale=exact_scale))


def summarize(spark: SparkSession, table_path: str, out_path: str, as_of: dt.datetime | str | None = None,
              exact_scale: int | None = None, partials_path: str | None = None) -> StepResult:
    """Daily summary of the loaded table (all runs), overwriting the summary output.

    With ``partials_path`` the summary is merged from the runs' partial summaries kept there, so that it costs
    what the runs loaded since cost, not what the table does.
    """
    if partials_path is None:
        return StepResult(write_parquet(daily_summary(read_table(spark, table_path), as_of=as_of, exact_scale=exact_scale), out_path), out_path)
    read = refresh_summary(spark, table_path, partials_path, exact_scale)
    merged = merge_summaries(SnapshotTable(spark, partials_path, (RUN_COLUMN,)).read(), as_of=as_of)
    return StepResult(write_parquet(merged, out_path), out_path, {"read": read})


def refresh_sketches(spark: SparkSession, table_path: str, sketches_path: str, columns: Sequence[str] = RECORD_SCHEMA.fieldNames()) -> list[str]:
    """Keep a distinct-count sketch of each run's ``columns``; only runs loaded since the last time are read."""
    table, sketches = run_table(spark, table_path), SnapshotTable(spark, sketches_path, (RUN_COLUMN,))
    return refresh(table, sketches, lambda df: distinct_sketches(df, columns, by=(RUN_COLUMN,)))


def stored_distinct(spark: SparkSession, sketches_path: str) -> DataFrame:
    """(run_id, distinct_rows): estimates for each run, and over all of them (run_id NULL), from the sketches alone."""
    return distinct_of_sketches(SnapshotTable(spark, sketches_path, (RUN_COLUMN,)).read(), by=(RUN_COLUMN,))


def _require_rows(rows: int, label: str) -> None:
    if rows <= 0:
        raise ValueError(f"{label} is empty")


def end_to_end(
    spark: SparkSession,
    source: DataFrame,
    workdir: str,
    source_system: str,
    as_of: dt.datetime | str | None = None,
    rid: str | None = None,
    metrics_path: str | None = None,
    audit_path: str | None = None,
    batched: bool = False,
    exact_scale: int | None = None,
) -> dict:
    """extract -> validate -> transform -> quality check -> load -> verify -> summary.

    Only what this run has landed is transformed and loaded, so a day costs
    what its own rows cost; the summary covers the table, from partial
    summaries of which only this run's is new.  ``exact_scale`` as in
    ``daily_summary``.

    With ``metrics_path`` one row per stage (rows in/out, rejected, error
    rate, seconds) is written for the run; with ``audit_path`` the load is
    recorded in the audit trail.  Both are partitioned by ``run_id``.
    ``batched=True`` transforms all landed datasets in one pass
    (``transform_batched``) instead of one job sequence per dataset.
    """
    rid = rid or new_run_id()
    base = workdir.rstrip("/")
    run = RunMetrics(rid)
    with run.stage("extract") as st:
        landed = extract(spark, source, f"{base}/raw", source_system, rid=rid, as_of=as_of,
                         expected=RECORD_SCHEMA.fieldNames(), label=None, numeric=("value",))
        _require_rows(landed.rows, "extracted data")  # observed on the write: no re-read
        st.rows_out = landed.rows
    dataset = _name(landed.path)
    with run.stage("transform", rows_in=landed.rows, rejects=True) as st:
        step = transform_batched if batched else transform
        processed = step(spark, f"{base}/raw", f"{base}/processed", as_of=as_of, only=[dataset])
        st.rows_out = processed.rows
        reports = processed.details["reports"].values()
        total = sum(r["total_rows"] for r in reports)
        st.quality_score = (1.0 - sum(r["duplicates"] for r in reports) / total) if total else None
        _require_rows(processed.rows, "processed data")
    processed_df = spark.read.parquet(f"{base}/processed/" + (f"{DATASET_COLUMN}={dataset}" if batched else f"{PROCESSED_PREFIX}{dataset}"))
    started = dt.datetime.now()
    with run.stage("load", rows_in=processed.rows) as st:
        loaded = load(spark, processed_df, f"{base}/warehouse/processed_data", as_of=as_of, rid=rid)
        verified = verify_load(spark, loaded.path, loaded.rows, rid=rid)
        st.rows_out = loaded.rows
    with run.stage("summary", rows_in=loaded.rows) as st:
        summary = summarize(spark, loaded.path, f"{base}/warehouse/daily_summary", as_of=as_of, exact_scale=exact_scale,
                            partials_path=f"{base}/warehouse/daily_summary_partials")
        st.rows_out = summary.rows
    if metrics_path:
        append_by_run(run.to_frame(spark), metrics_path)
    if audit_path:
        append_by_run(audit_frame(spark, rid, f"{base}/processed", loaded.path, loaded.rows, started,
                                  dt.datetime.now()), audit_path)
    return {
        "run_id": rid,
        "extracted": landed.rows,
        "processed": processed.rows,
        "loaded": loaded.rows,
        "verified": verified,
        "summary_rows": summary.rows,
        "summary_path": summary.path,
        "table_path": loaded.path,
        "reports": processed.details["reports"],
        "stages": [(m.stage, m.rows_in, m.rows_out, m.seconds) for m in run.stages],
    }
