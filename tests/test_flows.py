"""Jobs end to end: extract, transform, load (Parquet and JDBC), summary,
bookkeeping and incremental runs."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from sluice.plans import flows
from sluice.plans.metrics import RunMetrics, append_by_run, audit_frame, completed_runs
from sluice.schemas import RECORD_SCHEMA
from sluice.sinks.files import write_csv, write_parquet
from sluice.sources.derived import dirty_records, events_as_records
from sluice.sources.files import CSV_TIMESTAMP_FORMAT_MICROS
from sluice.streaming.incremental import incremental_transform, read_increments
from tests.conftest import FAULTY_ROWS, SF_SMALL

AS_OF = "2024-02-01 00:00:00"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _dirty_five(spark):
    return spark.createDataFrame(FAULTY_ROWS, RECORD_SCHEMA)


def test_end_to_end_on_dirty_rows(spark, tmp_dir):
    out = flows.end_to_end(spark, _dirty_five(spark), tmp_dir, "crm", as_of=AS_OF, rid="20240201_000000")
    assert (out["extracted"], out["processed"], out["loaded"], out["verified"]) == (5, 3, 3, 3)
    rep = out["reports"]["extracted_data_crm_20240201_000000"]
    assert (rep["total_rows"], rep["duplicates"], rep["null_counts"]["name"]) == (5, 1, 1)
    summary = spark.read.parquet(out["summary_path"])
    assert summary.agg(F.sum("record_count")).first()[0] == 3
    table = flows.read_table(spark, out["table_path"])
    assert table.where("source_system = 'crm' and extraction_timestamp is not null").count() == 3
    assert [s[0] for s in out["stages"]] == ["extract", "transform", "load", "summary"]


def test_end_to_end_batched_matches_loop(spark, tmp_dir):
    loop = flows.end_to_end(spark, _dirty_five(spark), f"{tmp_dir}/a", "crm", as_of=AS_OF, rid="r1")
    batched = flows.end_to_end(spark, _dirty_five(spark), f"{tmp_dir}/b", "crm", as_of=AS_OF, rid="r1", batched=True)
    assert (batched["processed"], batched["loaded"], batched["summary_rows"]) == (
        loop["processed"], loop["loaded"], loop["summary_rows"])
    a = spark.read.parquet(loop["summary_path"])
    b = spark.read.parquet(batched["summary_path"]).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_end_to_end_records_metrics_and_audit(spark, tmp_dir):
    flows.end_to_end(spark, _dirty_five(spark), f"{tmp_dir}/w", "crm", as_of=AS_OF, rid="r9",
                     metrics_path=f"{tmp_dir}/m", audit_path=f"{tmp_dir}/a")
    m = {r["stage"]: r for r in spark.read.parquet(f"{tmp_dir}/m").collect()}
    assert (m["transform"]["rows_in"], m["transform"]["rows_out"], m["transform"]["rejected"]) == (5, 3, 2)
    assert m["transform"]["quality_score"] == 0.8 and m["transform"]["error_rate"] == 0.4
    assert all(m[s]["rejected"] is None and m[s]["error_rate"] is None for s in ("extract", "load", "summary"))
    audit = spark.read.parquet(f"{tmp_dir}/a").first()
    assert (audit["run_id"], audit["rows"], audit["status"]) == ("r9", 3, "ok")


def test_transform_warns_about_duplicates_and_missing_values(spark, tmp_dir, caplog):
    write_parquet(_dirty_five(spark), f"{tmp_dir}/raw/extracted_data_w")
    with caplog.at_level("WARNING", logger="sluice"):
        flows.transform(spark, f"{tmp_dir}/raw", f"{tmp_dir}/p", as_of=AS_OF)
    text = caplog.text
    assert "1 duplicate rows of 5" in text and "column name has 1 missing values" in text


def test_transform_keeps_same_named_parquet_and_csv_apart(spark, tmp_dir):
    src = _dirty_five(spark)
    write_parquet(src, f"{tmp_dir}/raw/extracted_data_a")
    write_csv(src, f"{tmp_dir}/raw/extracted_data_a.csv", timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    res = flows.transform(spark, f"{tmp_dir}/raw", f"{tmp_dir}/processed", as_of=AS_OF, csv_schema=RECORD_SCHEMA)
    assert res.rows == 6 and sorted(os.listdir(f"{tmp_dir}/processed")) == [
        "transformed_extracted_data_a", "transformed_extracted_data_a_csv"]


def test_transform_batched_dedups_within_each_dataset(spark, tmp_dir):
    src = _dirty_five(spark)
    write_parquet(src, f"{tmp_dir}/raw/extracted_data_r1")
    write_parquet(src, f"{tmp_dir}/raw/extracted_data_r2")  # the same rows again, as another run
    res = flows.transform_batched(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", as_of=AS_OF, schema=RECORD_SCHEMA)
    assert res.rows == 6  # 3 per dataset: copies across datasets are kept, like the per-dataset loop
    assert sorted(res.details["reports"]) == ["extracted_data_r1", "extracted_data_r2"]
    rep = res.details["reports"]["extracted_data_r1"]
    assert (rep["total_rows"], rep["duplicates"], rep["missing_name"]) == (5, 1, 1)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert {r["dataset"]: r["count"] for r in out.groupBy("dataset").count().collect()} == {
        "extracted_data_r1": 3, "extracted_data_r2": 3}
    loop = flows.transform(spark, f"{tmp_dir}/raw", f"{tmp_dir}/loop", as_of=AS_OF)
    assert loop.rows == res.rows


def test_transform_batched_tags_partitioned_datasets(spark, tmp_dir):
    src = _dirty_five(spark).withColumn("part", F.col("id") % 2)
    src.write.partitionBy("part").parquet(f"{tmp_dir}/raw/extracted_data_r1")
    res = flows.transform_batched(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", as_of=AS_OF)
    assert list(res.details["reports"]) == ["extracted_data_r1"]


def test_second_day_adds_to_the_month(spark, tmp_dir):
    out = [flows.end_to_end(spark, _dirty_five(spark).withColumn("id", F.col("id") + 100 * i), tmp_dir, "crm", as_of=AS_OF, rid=rid)
           for i, rid in enumerate(["r1", "r2", "r1"])]
    assert [o["loaded"] for o in out] == [3, 3, 3] and [o["reports"].keys() for o in out] == [
        {"extracted_data_crm_r1"}, {"extracted_data_crm_r2"}, {"extracted_data_crm_r1"}]
    table = flows.read_table(spark, out[0]["table_path"])
    assert table.count() == 6 and {r["id"] for r in table.where("run_id = 'r1'").collect()} == {221, 223, 224}
    assert spark.read.parquet(out[0]["summary_path"]).agg(F.sum("record_count")).first()[0] == 6


def test_load_replaces_its_own_run_only(spark, tmp_dir):
    recs = flows.transform_dataset(events_as_records(spark.read.parquet(f"{SF_SMALL}/events.parquet")), AS_OF)
    first = flows.load(spark, recs, f"{tmp_dir}/t", as_of=AS_OF, rid="r1")
    other = flows.load(spark, recs.where("id % 2 = 0"), f"{tmp_dir}/t", as_of=AS_OF, rid="r2")
    # the same run again, without the rows of most days: no partition of the first attempt stays
    again = flows.load(spark, recs.where("day = 3"), f"{tmp_dir}/t", as_of=AS_OF, rid="r1")
    assert first.rows > again.rows > 0
    assert flows.read_table(spark, f"{tmp_dir}/t").count() == again.rows + other.rows
    assert flows.verify_load(spark, f"{tmp_dir}/t", again.rows, rid="r1") == again.rows
    for wrong in (again.rows + 1, again.rows - 1):
        with pytest.raises(ValueError, match="verification failed"):
            flows.verify_load(spark, f"{tmp_dir}/t", wrong, rid="r1")


def test_large_ids_and_unknown_timestamps_load(spark, tmp_dir):
    rows = spark.createDataFrame([(3_000_000_000, "a", 0.004, None), (-5, "b", 0.004, dt.datetime(2024, 1, 1))],
                                 "id bigint, name string, value double, timestamp timestamp_ntz")
    flows.load(spark, flows.transform_dataset(rows, AS_OF), f"{tmp_dir}/t", as_of=AS_OF, rid="r1")
    flows.load(spark, flows.transform_dataset(rows, AS_OF), f"{tmp_dir}/t", as_of=AS_OF, rid="r2")
    back = flows.read_table(spark, f"{tmp_dir}/t")
    assert back.count() == 4 and back.where("id = 3000000000 and timestamp is null").count() == 2
    flows.summarize(spark, f"{tmp_dir}/t", f"{tmp_dir}/s", as_of=AS_OF)
    assert {(r["avg_value"], r["min_value"]) for r in spark.read.parquet(f"{tmp_dir}/s").collect()} == {(0.004, 0.004)}
    with pytest.raises(ValueError, match="not in target"):
        flows.load(spark, rows.withColumn("tenure", F.lit(1)), f"{tmp_dir}/t", as_of=AS_OF, rid="r3")


def test_csv_without_a_schema_is_transformed(spark, tmp_dir):
    write_csv(_dirty_five(spark), f"{tmp_dir}/raw/five.csv")
    res = flows.transform(spark, f"{tmp_dir}/raw", f"{tmp_dir}/processed", as_of=AS_OF)
    assert res.rows == 3 and list(res.details["reports"]) == ["five.csv"]
    with pytest.raises(ValueError, match="CSV datasets"):
        flows.transform_batched(spark, f"{tmp_dir}/raw", f"{tmp_dir}/batched", as_of=AS_OF)
    with pytest.raises(FileNotFoundError, match="other"):
        flows.transform(spark, f"{tmp_dir}/raw", f"{tmp_dir}/processed", as_of=AS_OF, only=["other"])


def test_datasets_are_named_below_the_raw_root(spark, tmp_dir):
    raw = f"{tmp_dir}/extracted_data/extracted_data_root"
    for name in ("extracted_data_r1", "extracted_data_r2"):
        write_parquet(_dirty_five(spark), f"{raw}/{name}")
    res = flows.transform_batched(spark, raw, f"{tmp_dir}/out", as_of=AS_OF)
    assert res.rows == 6 and sorted(res.details["reports"]) == ["extracted_data_r1", "extracted_data_r2"]


def test_sources_with_one_run_id_land_apart(spark, tmp_dir):
    a = flows.extract(spark, _dirty_five(spark), f"{tmp_dir}/raw", "crm", rid="r1", as_of=AS_OF)
    b = flows.extract(spark, _dirty_five(spark), f"{tmp_dir}/raw", "shop/eu", rid="r1", as_of=AS_OF)
    assert a.path != b.path and spark.read.parquet(f"{tmp_dir}/raw/*").count() == 10
    profile = a.details["profile"]
    assert profile["null_counts"]["name"] == 1 and "Tenure" in profile["missing_columns"] and not profile["labels"]


def test_extract_from_csv_with_export_and_snapshot(spark, tmp_dir):
    src = _dirty_five(spark)
    write_csv(src, f"{tmp_dir}/input/data.csv", timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    res = flows.extract(spark, f"{tmp_dir}/input/data.csv", f"{tmp_dir}/raw", "crm_csv", rid="r1",
                        schema=RECORD_SCHEMA, as_of=AS_OF, export_root=f"{tmp_dir}/exports")
    assert res.rows == 5 and res.path.endswith("extracted_data_crm_csv_r1")
    assert os.path.isdir(res.details["csv"])
    landed = spark.read.parquet(res.path)
    assert set(landed.columns) == {"id", "name", "value", "timestamp", "extraction_timestamp", "source_system"}
    snap = flows.snapshot_source(spark, src, f"{tmp_dir}/raw", "r1")
    assert snap.rows == 5 and "extraction_timestamp" not in spark.read.parquet(snap.path).columns
    # the CSV export is not picked up as a second landed dataset
    found = flows.discover_datasets(spark, f"{tmp_dir}/raw", dir_marker=flows.RAW_MARKER)
    assert len(found["parquet"]) == 1 and not found["csv"]


def test_transform_sql_matches_api_on_shared_rows(spark):
    dirty = dirty_records(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    sql = flows.transform_sql(dirty, as_of=AS_OF, with_hash=False)
    api = flows.transform_dataset(dirty, AS_OF, required_columns=["name"], with_hash=False)
    keys = ["id", "name", "value", "timestamp", "year", "month", "value_category"]
    assert api.select(*keys).exceptAll(sql.select(*keys)).count() == 0  # API is the de-duplicated SQL result
    assert sql.count() >= api.count()


def test_jdbc_load_verify_summary(spark):
    url = f"jdbc:derby:memory:flows_{uuid.uuid4().hex[:8]};create=true"
    recs = flows.transform_dataset(events_as_records(spark.read.parquet(f"{SF_SMALL}/events.parquet")), AS_OF)
    loaded = flows.load_jdbc(recs, url, "PROCESSED_DATA", DERBY, as_of=AS_OF, num_partitions=2)
    assert flows.verify_jdbc(spark, url, "PROCESSED_DATA", DERBY, loaded.rows) == loaded.rows
    summary = flows.summarize_jdbc(spark, url, "PROCESSED_DATA", "DAILY_SUMMARY", DERBY, as_of=AS_OF)
    assert summary.rows > 0
    assert flows.summarize_jdbc(spark, url, "PROCESSED_DATA", "DAILY_SUMMARY", DERBY, as_of=AS_OF).rows == summary.rows
    src = flows.extract_jdbc(spark, url, "DAILY_SUMMARY", DERBY)
    assert src.count() == summary.rows


def test_jdbc_load_is_guarded_by_run_id(spark, tmp_dir):
    url = f"jdbc:derby:memory:guard_{uuid.uuid4().hex[:8]};create=true"
    recs = flows.transform_dataset(events_as_records(spark.read.parquet(f"{SF_SMALL}/events.parquet")), AS_OF)
    first = flows.load_jdbc(recs, url, "PD", DERBY, as_of=AS_OF, rid="r1", audit_path=f"{tmp_dir}/audit")
    again = flows.load_jdbc(recs, url, "PD", DERBY, as_of=AS_OF, rid="r1", audit_path=f"{tmp_dir}/audit")
    assert first.rows > 0 and again.rows == 0 and again.details["skipped"]
    assert flows.verify_jdbc(spark, url, "PD", DERBY) == first.rows
    second_run = flows.load_jdbc(recs, url, "PD", DERBY, as_of=AS_OF, rid="r2", audit_path=f"{tmp_dir}/audit")
    assert flows.verify_jdbc(spark, url, "PD", DERBY) == first.rows + second_run.rows


def test_failed_jdbc_load_raises_and_is_retried(spark, tmp_dir):
    recs = flows.transform_dataset(_dirty_five(spark), AS_OF)
    missing_db = f"jdbc:derby:memory:absent_{uuid.uuid4().hex[:8]}"  # no create=true: connection fails
    with pytest.raises(Exception):
        flows.load_jdbc(recs, missing_db, "PD", DERBY, as_of=AS_OF, rid="r1", audit_path=f"{tmp_dir}/audit")
    assert not os.path.exists(f"{tmp_dir}/audit")  # nothing recorded, so the run is retried
    ok_db = f"jdbc:derby:memory:retry_{uuid.uuid4().hex[:8]};create=true"
    # one row fails in its writer: nothing of the load reaches the table, and the repeated load has each row once
    broken = recs.withColumn("value", F.when(F.col("id") == 24, F.raise_error(F.lit("broken row"))).otherwise(F.col("value")).cast("int"))
    with pytest.raises(Exception, match="broken row"):
        flows.load_jdbc(broken, ok_db, "PD", DERBY, as_of=AS_OF, rid="r1", audit_path=f"{tmp_dir}/audit", num_partitions=3)
    assert flows.read_jdbc(spark, ok_db, "PD", DERBY).count() == 0
    res = flows.load_jdbc(recs, ok_db, "PD", DERBY, as_of=AS_OF, rid="r1", audit_path=f"{tmp_dir}/audit")
    assert res.rows == 3 and not res.details["skipped"] and flows.verify_jdbc(spark, ok_db, "PD", DERBY, 3) == 3


def test_metrics_and_audit(spark, tmp_dir):
    run = RunMetrics("r1")
    with run.stage("clean", rows_in=10, rejects=True) as st:
        st.rows_out = 8
    frame = run.to_frame(spark, at=dt.datetime(2024, 2, 1))
    row = frame.first()
    assert (row["rejected"], row["error_rate"], row["status"]) == (2, 0.2, "ok")
    append_by_run(frame, f"{tmp_dir}/metrics")
    append_by_run(frame, f"{tmp_dir}/metrics")
    assert spark.read.parquet(f"{tmp_dir}/metrics").count() == 1
    audit = audit_frame(spark, "r1", "raw", "processed_data", 8, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1))
    append_by_run(audit, f"{tmp_dir}/audit")
    assert [r["run_id"] for r in completed_runs(spark, f"{tmp_dir}/audit").collect()] == ["r1"]


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_incremental_transform_gives_the_batch_result(spark, tmp_dir, per_trigger):
    src = _dirty_five(spark)
    run = lambda: incremental_transform(spark, f"{tmp_dir}/raw", RECORD_SCHEMA, f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ckpt",
                                        as_of=AS_OF, max_files_per_trigger=per_trigger)
    write_parquet(src.repartition(3), f"{tmp_dir}/raw/extracted_data_r1")
    write_parquet(src, f"{tmp_dir}/raw/extracted_data_r2")  # the same rows, landed before the first run too
    first = run()
    assert first["rows"] == 6 and first["datasets"] == ["extracted_data_r1", "extracted_data_r2"]
    write_parquet(src.withColumn("id", F.col("id") + 20), f"{tmp_dir}/raw/extracted_data_r3")
    assert run()["datasets"] == ["extracted_data_r3"]
    assert run() == {"batches": 0, "datasets": [], "rows": 0, "read": 0}
    batch = flows.transform_batched(spark, f"{tmp_dir}/raw", f"{tmp_dir}/whole", as_of=AS_OF)
    a, b = read_increments(spark, f"{tmp_dir}/out"), spark.read.parquet(f"{tmp_dir}/whole")
    assert batch.rows == a.count() == 9
    assert a.select(b.columns).exceptAll(b).count() == 0
