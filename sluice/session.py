"""Session helpers.

Operators never create, reconfigure or stop a session: they take the caller's
``SparkSession``.  ``build_session`` exists for tests, the bench and scripts
that own their process; ``scratch_dir`` hands out fresh folders below the
cluster's shared checkpoint location.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Tuning the reference job sets on every session (AQE with
    # partition coalescing and skew-join splitting, Arrow transfer in batches
    # of 10000 rows, 600s network timeout).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.network.timeout": "600s",
    # Ours: zone-free clock, partition-scoped overwrites, no web UI.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


# The reference's write and read tuning presets (AQE settings).
WRITE_PRESET = {
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionNum": "1",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4",
}
READ_PRESET = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_preset(spark: SparkSession, preset: dict[str, str]) -> SparkSession:
    """Set a group of runtime SQL options on a session the caller owns."""
    for key, value in preset.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "sluice",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    enable_hive: bool = False,
) -> SparkSession:
    """Create (or return the active) session with the library defaults.

    ``master`` is left to the deployment unless given (``spark-submit`` sets it
    on a cluster).  No ``spark.jars.packages`` is set: JDBC drivers come from the
    cluster image, so nothing is downloaded at start-up.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    if enable_hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def stop_session(spark: SparkSession | None) -> None:
    """Stop a session the caller owns; ``None`` is accepted and ignored."""
    if spark is not None:
        spark.stop()


_local_folders: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder that all executors share: ``spark.checkpoint.dir``, or the context's own.

    Only a session on a ``local`` master - tests, a laptop - may go without
    one and gets a fresh local folder; on a cluster that is an error, since
    no executor would see another's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    configured = configured or (sc.getCheckpointDir() if sc is not None else None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master: {master!r})")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="sluice-ckpt-")
    return _local_folders[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder for one write, below the checkpoint dir."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/sluice-scratch/{label}-{uuid.uuid4().hex[:12]}"


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None
