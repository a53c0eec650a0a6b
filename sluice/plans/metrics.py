"""Run bookkeeping: per-stage metrics and the load audit trail.

Row counts come from ``Observation`` objects attached to the stage's own
write (see ``sluice.sinks.files.observed``), so metrics cost no extra job.
Metrics and audit rows are a handful per run; they are appended to Parquet
tables partitioned by ``run_id``, so a re-run replaces its own rows.
"""

from __future__ import annotations

import datetime as dt
import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = ("run_id string, stage string, rows_in bigint, rows_out bigint, rejected bigint, "
                  "error_rate double, quality_score double, seconds double, status string, recorded_at timestamp_ntz")
AUDIT_SCHEMA = ("run_id string, source string, target string, rows bigint, started_at timestamp_ntz, "
                "finished_at timestamp_ntz, status string")


@dataclass
class StageMetric:
    stage: str
    rows_in: int | None = None
    rows_out: int | None = None
    seconds: float = 0.0
    status: str = "ok"
    quality_score: float | None = None
    rejects: bool = False  # whether rows that don't come out were turned away

    @property
    def rejected(self) -> int | None:
        if not self.rejects or self.rows_in is None or self.rows_out is None:
            return None
        return self.rows_in - self.rows_out

    @property
    def error_rate(self) -> float | None:
        if not self.rows_in or self.rejected is None:
            return None
        return self.rejected / self.rows_in


@dataclass
class RunMetrics:
    run_id: str
    stages: list[StageMetric] = field(default_factory=list)

    @contextmanager
    def stage(self, name: str, rows_in: int | None = None, rejects: bool = False):
        """Time a stage; the body sets ``rows_out`` (and optionally
        ``quality_score``) on the yielded record.  Only a stage that
        ``rejects`` rows has an error rate: others may well change their number."""
        rec = StageMetric(name, rows_in=rows_in, rejects=rejects)
        t0 = time.perf_counter()
        try:
            yield rec
        except Exception:
            rec.status = "failed"
            raise
        finally:
            rec.seconds = round(time.perf_counter() - t0, 3)
            self.stages.append(rec)

    def to_frame(self, spark: SparkSession, at: dt.datetime | None = None) -> DataFrame:
        now = at or dt.datetime.now()
        data = [(self.run_id, s.stage, s.rows_in, s.rows_out, s.rejected, s.error_rate, s.quality_score,
                 float(s.seconds), s.status, now) for s in self.stages]
        return spark.createDataFrame(data, METRICS_SCHEMA)


def audit_frame(spark: SparkSession, run_id: str, source: str, target: str, rows: int,
                started_at: dt.datetime, finished_at: dt.datetime, status: str = "ok") -> DataFrame:
    return spark.createDataFrame([(run_id, source, target, rows, started_at, finished_at, status)], AUDIT_SCHEMA)


def append_by_run(df: DataFrame, path: str) -> None:
    """Write bookkeeping rows into ``path`` partitioned by ``run_id``;
    dynamic partition overwrite makes a re-run replace its own rows."""
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id").parquet(path))


def completed_runs(spark: SparkSession, audit_path: str) -> DataFrame:
    """Run ids with a successful audit record (for run-id guards)."""
    return spark.read.parquet(audit_path).where(F.col("status") == "ok").select("run_id").distinct()
