"""File sources and sinks with real reads and writes in fresh folders."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.conform import conform_to_schema, create_target_table
from sluice.operators.modeling import file_fingerprints, unseen_files
from sluice.schemas import PROCESSED_SCHEMA, RECORD_SCHEMA
from sluice.sinks.files import run_id, run_output_path, write_csv, write_parquet, write_partitioned
from sluice.sources.files import (
    CSV_TIMESTAMP_FORMAT, discover_datasets, path_exists, read_csv, read_or_empty, read_parquet, with_source_file,
)
from tests.conftest import SAMPLE_ROWS, rows


def test_csv_round_trip_explicit_schema(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    n = write_csv(df, f"{tmp_dir}/s.csv", single_file=True)
    assert n == 5
    parts = [f for f in os.listdir(f"{tmp_dir}/s.csv") if f.endswith(".csv")]
    assert len(parts) == 1
    back = read_csv(spark, f"{tmp_dir}/s.csv", schema=RECORD_SCHEMA, timestamp_format=CSV_TIMESTAMP_FORMAT)
    assert rows(back, ["id"]) == rows(df, ["id"])


def test_csv_infer_schema_gives_bigint(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    write_csv(df, f"{tmp_dir}/s.csv")
    inferred = read_csv(spark, f"{tmp_dir}/s.csv")
    types = dict(inferred.dtypes)
    assert types["id"] in ("int", "bigint") and types["name"] == "string"


def test_parquet_many_runs_read_as_one(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    rid = run_id(dt.datetime(2024, 1, 15, 10, 30))
    assert rid == "20240115_103000"
    write_parquet(df, run_output_path(f"{tmp_dir}/raw/extracted_data", rid))
    write_parquet(df.withColumn("extra", F.lit(1)), run_output_path(f"{tmp_dir}/raw/extracted_data", "20240116_000000"))
    both = read_parquet(spark, f"{tmp_dir}/raw/extracted_data_*", merge_schema=True)
    assert both.count() == 10 and "extra" in both.columns


def test_partitioned_write_is_idempotent_and_prunes(spark, tmp_dir):
    base = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA).withColumns(
        {"year": F.year("timestamp"), "month": F.month("timestamp")})
    base = base.withColumns({"year": F.lit(2024), "month": F.lit(5)})
    june = base.withColumn("month", F.lit(6))
    path = f"{tmp_dir}/t"
    write_partitioned(base.unionByName(june), path)
    assert write_partitioned(base, path) == 5  # May again
    back = spark.read.parquet(path)
    assert back.count() == 10
    assert sorted(os.listdir(f"{path}/year=2024")) == ["month=5", "month=6"]
    plan = back.where("year = 2024 and month = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan


def test_discover_datasets(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    write_parquet(df, f"{tmp_dir}/raw/extracted_data_1")
    write_parquet(df, f"{tmp_dir}/raw/other_1")
    write_csv(df, f"{tmp_dir}/raw/records.csv")
    found = discover_datasets(spark, f"{tmp_dir}/raw", dir_marker="extracted_data")
    assert [p.rsplit("/", 1)[-1] for p in found["parquet"]] == ["extracted_data_1"]
    assert [p.rsplit("/", 1)[-1] for p in found["csv"]] == ["records.csv"]
    assert discover_datasets(spark, f"{tmp_dir}/missing") == {"parquet": [], "csv": []}
    with pytest.raises(FileNotFoundError):
        discover_datasets(spark, f"{tmp_dir}/missing", on_missing="error")
    assert path_exists(spark, f"{tmp_dir}/raw") and not path_exists(spark, f"{tmp_dir}/nope")


def test_read_or_empty(spark, tmp_dir):
    df = read_or_empty(spark, f"{tmp_dir}/absent", RECORD_SCHEMA)
    assert df.count() == 0 and df.schema == RECORD_SCHEMA
    with pytest.raises(AnalysisException):
        read_or_empty(spark, f"{tmp_dir}/absent", RECORD_SCHEMA, on_missing="error")


def test_conform_to_schema(spark, sample_df):
    out = conform_to_schema(sample_df.withColumn("junk", F.lit(1)), PROCESSED_SCHEMA, extra="drop")
    assert out.schema == PROCESSED_SCHEMA
    assert out.where("name_hash is null and load_timestamp is null").count() == 5
    with pytest.raises(ValueError):
        conform_to_schema(sample_df.withColumn("junk", F.lit(1)), PROCESSED_SCHEMA)
    bad = spark.createDataFrame([("x",), ("7",)], "id string")
    tried = conform_to_schema(bad, T.StructType([T.StructField("id", T.IntegerType())]), cast="try")
    assert sorted((r["id"] is None, r["id"]) for r in tried.collect()) == [(False, 7), (True, None)]


def test_create_target_table(spark, tmp_dir):
    assert create_target_table(spark, "processed_data_t", PROCESSED_SCHEMA, location=f"{tmp_dir}/pd",
                               partition_by=("year", "month")) is True
    assert create_target_table(spark, "processed_data_t", PROCESSED_SCHEMA) is True
    assert spark.table("processed_data_t").count() == 0
    spark.sql("DROP TABLE processed_data_t")


def test_lineage_and_fingerprints(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    write_parquet(df, f"{tmp_dir}/a")
    lin = with_source_file(spark.read.parquet(f"{tmp_dir}/a"))
    assert all(r["source_file"].endswith(".parquet") for r in lin.collect())
    fps = file_fingerprints(spark, f"{tmp_dir}/a/*.parquet")
    assert fps.agg(F.sum("rows")).first()[0] == 5 and fps.where("digest is null or length <= 0").count() == 0
    assert unseen_files(fps, fps).count() == 0
    write_parquet(df.coalesce(1).orderBy(F.desc("id")), f"{tmp_dir}/b")  # the same rows in another order
    write_parquet(df.coalesce(1).withColumn("value", F.col("value") + 1), f"{tmp_dir}/c")
    digests = {f: file_fingerprints(spark, f"{tmp_dir}/{f}").agg(F.sum(F.col("digest").cast("decimal(38,0)"))).first()[0] for f in "abc"}
    assert digests["a"] == digests["b"] != digests["c"]
    meta_only = file_fingerprints(spark, f"{tmp_dir}/a/*.parquet", content=False)
    assert meta_only.where("digest is null").count() == meta_only.count()


def test_discovery_without_the_jvm_gateway(spark, tmp_dir, monkeypatch):
    # Spark Connect has no JVM gateway: listing falls back to a Spark file scan
    import sluice.sources.files as files

    df = spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA)
    write_parquet(df, f"{tmp_dir}/raw/extracted_data_1")
    write_csv(df, f"{tmp_dir}/raw/records.csv")
    expected = discover_datasets(spark, f"{tmp_dir}/raw", dir_marker="extracted_data")
    monkeypatch.setattr(files, "_gateway_available", lambda _spark: False)
    assert files.path_exists(spark, f"{tmp_dir}/raw") and not files.path_exists(spark, f"{tmp_dir}/none")
    assert files.glob_exists(spark, f"{tmp_dir}/raw/extracted_data_*")
    got = files.discover_datasets(spark, f"{tmp_dir}/raw", dir_marker="extracted_data")
    assert got == expected and len(got["parquet"]) == 1 and len(got["csv"]) == 1


def test_views_and_literal_tables(spark):
    from sluice.plans.flows import register_view
    from sluice.sources.files import literal_table

    register_view(literal_table(spark, [(1, "a"), (2, None)], "id int, name string"), "small_t")
    assert spark.sql("select count(name) as n from small_t").first()["n"] == 1
    assert literal_table(spark, [], "id int").count() == 0
    spark.catalog.dropTempView("small_t")
