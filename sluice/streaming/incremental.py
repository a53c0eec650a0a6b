"""Daily transform over newly landed files only, with Structured Streaming.

The batch ``transform`` job re-reads every landed dataset on every run.  Here
the file source remembers which files it has seen, and the state store which
rows: each scheduled run with ``trigger(availableNow=True)`` reads the files
landed since the run before, cleans their rows, and lets through those that
their dataset hasn't had yet.  Work is in proportion to the new rows, however
many there are of the dataset already; the state holds a 32-byte digest of
each distinct row, dealt out over the shuffle partitions.

The result is that of the batch transform wherever micro-batches begin and
end.  Only where copies of a row come with different stamps, the first copy
seen keeps its own, since what has been written isn't taken back.

Each micro-batch is one commit to a snapshot table with a slot per dataset and
batch.  A batch that is run again replaces what it wrote, so nothing comes
twice, and readers (``read_increments``) never meet half a batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import row_digest
from sluice.operators.clean import business_columns, clean_rows
from sluice.operators.enrich import enrich_records
from sluice.plans.flows import DATASET_COLUMN, RAW_MARKER
from sluice.sinks.snapshots import SnapshotTable, slot_values
from sluice.sources.files import qualified_depth

BATCH_COLUMN = "batch"


def increments_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, (DATASET_COLUMN, BATCH_COLUMN))


def read_increments(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows transformed so far, each with its dataset; ``schema`` serves a table to which nothing was committed."""
    return increments_table(spark, path).read(schema=schema).drop(BATCH_COLUMN)


def first_seen(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of a stream: the rows whose ``columns`` have not come before."""
    return rows.withColumn("__digest", row_digest(rows, columns)).dropDuplicates(["__digest"]).drop("__digest")


def incremental_transform(
    spark: SparkSession,
    raw_root: str,
    schema: T.StructType,
    processed_path: str,
    checkpoint: str,
    as_of: dt.datetime | str | None = None,
    with_hash: bool = True,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Run once over the files of ``<raw_root>/extracted_data_*`` not seen
    before; returns ``{"batches": n, "datasets": names, "rows": m, "read": k}``
    of this run: rows written, and rows read from files.  ``checkpoint`` is a
    folder that outlives the process and that all executors share."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    root = raw_root.rstrip("/")
    path = F.regexp_replace("_metadata.file_path", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    raw = reader.parquet(f"{root}/{RAW_MARKER}_*").withColumn(DATASET_COLUMN, F.split(path, "/")[qualified_depth(spark, root)])
    cleaned = clean_rows(raw, carry=(DATASET_COLUMN,))
    out = enrich_records(first_seen(cleaned, business_columns(cleaned)), as_of=as_of, with_hash=with_hash)
    table, done = increments_table(spark, processed_path), {"batches": 0, "rows": 0}
    names: set[str] = set()

    def process(batch: DataFrame, batch_id: int) -> None:
        # the query's id is that of its checkpoint, so batches of another checkpoint have other names
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        name = f"{query}-{batch_id}"
        staged = table.stage(batch.withColumn(BATCH_COLUMN, F.lit(name)))
        done["batches"] += 1
        if staged.slots:
            table.commit(staged, drop=lambda slot: slot_values(slot)[BATCH_COLUMN] == name)
        done["rows"] += staged.rows
        names.update(slot_values(slot)[DATASET_COLUMN] for slot in staged.slots)

    query = out.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return {**done, "datasets": sorted(names), "read": sum(p["numInputRows"] for p in query.recentProgress)}
