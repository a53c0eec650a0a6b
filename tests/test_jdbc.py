"""JDBC source and sinks against an in-memory Derby database.

Derby ships with PySpark and runs inside this JVM: no server, no port.  An
in-memory database is visible only to its own process, which is why the
JDBC operators are checked here and not as cluster queries.
"""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from sluice.operators.summarize import daily_summary
from sluice.sinks.jdbc import create_table_jdbc, table_exists_jdbc, write_jdbc
from sluice.sources.jdbc import jdbc_bounds, jdbc_config_from_env, modulo_predicates, read_jdbc
from sluice.sources.derived import events_as_records
from sluice.operators.clean import clean_records
from sluice.operators.enrich import enrich_records
from tests.conftest import SF_SMALL

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture()
def url():
    return f"jdbc:derby:memory:sluice_{uuid.uuid4().hex[:10]};create=true"


def test_append_overwrite_and_partitioned_read(spark, url):
    df = spark.range(1, 101).select(F.col("id").cast("int").alias("id"), (F.col("id") * 1.5).alias("value"))
    assert write_jdbc(df, url, "T1", DERBY, mode="append", num_partitions=4) == 100
    assert write_jdbc(df, url, "T1", DERBY, mode="append") == 100
    assert jdbc_bounds(spark, url, "T1", "id", DERBY) == (1, 100)
    back = read_jdbc(spark, url, "T1", DERBY, partition_column="id", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 200
    filtered = back.where("value > 140")
    assert "value" in filtered._jdf.queryExecution().executedPlan().toString()
    assert filtered.count() == 2 * 7
    assert write_jdbc(df.limit(10), url, "T1", DERBY, mode="overwrite") == 10
    assert read_jdbc(spark, url, "T1", DERBY).count() == 10


def test_create_table_and_empty_source(spark, url):
    schema = "id int, value double"
    from pyspark.sql import types as T

    st = T._parse_datatype_string(schema)
    assert not table_exists_jdbc(spark, url, "T2", DERBY)
    assert create_table_jdbc(spark, url, "T2", st, DERBY) is True
    assert table_exists_jdbc(spark, url, "T2", DERBY)
    assert create_table_jdbc(spark, url, "T2", st, DERBY) is True
    assert read_jdbc(spark, url, "T2", DERBY).count() == 0
    assert create_table_jdbc(spark, url, "T3", T._parse_datatype_string("id int, name string"), DERBY,
                             column_types="name VARCHAR(255)") is True
    write_jdbc(spark.createDataFrame([(1, "x")], "id int, name string"), url, "T3", DERBY)
    assert read_jdbc(spark, url, "T3", DERBY).first()["name"] == "x"


def test_load_and_summary_round_trip(spark, url):
    recs = events_as_records(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    enriched = enrich_records(clean_records(recs), as_of="2024-02-01 00:00:00", with_hash=True)
    n = write_jdbc(enriched.withColumn("load_timestamp", F.lit(dt.datetime(2024, 2, 1))),
                   url, "PROCESSED_DATA", DERBY, mode="append")
    loaded = read_jdbc(spark, url, "PROCESSED_DATA", DERBY, partition_column="id", num_partitions=3)
    assert loaded.count() == n == enriched.count()
    summary = daily_summary(loaded, as_of="2024-02-01 00:00:00", exact_scale=2)
    assert write_jdbc(summary, url, "DAILY_SUMMARY", DERBY, mode="overwrite") == summary.count()
    expect = daily_summary(enriched, as_of="2024-02-01 00:00:00", exact_scale=2).drop("summary_timestamp")
    got = read_jdbc(spark, url, "DAILY_SUMMARY", DERBY).drop("SUMMARY_TIMESTAMP", "summary_timestamp")
    assert got.select(*expect.columns).exceptAll(expect).count() == 0


def test_source_and_target_have_settings_of_their_own(monkeypatch):
    for key in ("HOST", "PORT", "DB", "NAME", "USER", "PASSWORD"):
        monkeypatch.delenv(f"SOURCE_DB_{key}", raising=False)
        monkeypatch.delenv(f"POSTGRES_{key}", raising=False)
    source = jdbc_config_from_env("SOURCE_DB")
    assert source["url"] == "jdbc:postgresql://localhost:5432/source_db" and source["properties"]["user"] == "postgres"
    monkeypatch.setenv("SOURCE_DB_NAME", "shop")
    assert jdbc_config_from_env("SOURCE_DB")["url"].endswith("/shop")
    assert jdbc_config_from_env()["url"] == "jdbc:postgresql://localhost:5433/elt_db"


def test_remainders_cover_negative_keys(spark, url):
    write_jdbc(spark.range(-100, 101).select(F.col("id")), url, "NEG", DERBY)
    back = read_jdbc(spark, url, "NEG", DERBY, predicates=modulo_predicates("id", 4))
    assert back.count() == 201 and back.distinct().count() == 201
    from sluice.plans.flows import extract_jdbc

    whole = extract_jdbc(spark, url, "NEG", DERBY, num_partitions=4)
    assert whole.rdd.getNumPartitions() == 5 and whole.count() == 201


def test_env_config(monkeypatch):
    monkeypatch.setenv("POSTGRES_HOST", "db")
    monkeypatch.setenv("POSTGRES_PORT", "5432")
    cfg = jdbc_config_from_env()
    assert cfg["url"] == "jdbc:postgresql://db:5432/elt_db"
    assert cfg["properties"]["driver"] == "org.postgresql.Driver"


def test_partitioned_read_on_timestamp_and_empty_table(spark, url):
    df = spark.range(0, 48).select(
        F.col("id").cast("int").alias("id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"))
    write_jdbc(df, url, "TS", DERBY, mode="append")
    lo, hi = jdbc_bounds(spark, url, "TS", "ts", DERBY)
    assert lo < hi
    back = read_jdbc(spark, url, "TS", DERBY, partition_column="ts", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 48
    write_jdbc(df.limit(0), url, "EMPTY_T", DERBY, mode="append")
    assert jdbc_bounds(spark, url, "EMPTY_T", "id", DERBY) == (None, None)
    assert read_jdbc(spark, url, "EMPTY_T", DERBY, partition_column="id").count() == 0


def test_predicate_split_is_even_on_a_skewed_key(spark, url):
    # ids crowd into one end of the key space: range splits would put most rows in one task
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2900, F.col("id")).otherwise(F.col("id") * 1001).cast("bigint").alias("id"))
    df = df.unionByName(spark.createDataFrame([(None,)], "id bigint")).withColumn("id", F.when(F.col("id") % 5 == 0, -F.col("id")).otherwise(F.col("id")))
    write_jdbc(df, url, "SKEWED", DERBY)
    ranged = read_jdbc(spark, url, "SKEWED", DERBY, partition_column="id", num_partitions=4)
    by_mod = read_jdbc(spark, url, "SKEWED", DERBY, predicates=modulo_predicates("id", 4))
    assert by_mod.count() == ranged.count() == 3001
    sizes = by_mod.rdd.glom().map(len).collect()
    ranged_sizes = ranged.rdd.glom().map(len).collect()
    assert max(sizes[:4]) <= 1.1 * min(sizes[:4]) and sizes[4] == 1
    assert max(ranged_sizes) > 2 * max(sizes)
