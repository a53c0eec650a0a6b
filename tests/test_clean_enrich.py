"""Cleaning and enrichment on literal tables (the transform step's cases)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluice.functions.columns import snake_case
from sluice.operators import clean as C
from sluice.operators import enrich as E
from sluice.plans.flows import transform_sql
from tests.conftest import FAULTY_ROWS, SAMPLE_BANDS, rows

COLS = ["id", "name", "value", "timestamp"]
NOW = dt.datetime(2024, 1, 1)


def test_drop_all_null(spark):
    df = spark.createDataFrame(
        [(None, None, None, None), (31, "bolt", 8, NOW), (None, None, None, None), (32, None, 9, None)],
        "id bigint, name string, value bigint, timestamp timestamp")
    assert C.clean_records(df).count() == 2


def test_drop_all_null_ignores_lineage_columns(spark):
    df = spark.createDataFrame([(None, None, "csv")], "id bigint, name string, source_system string")
    assert C.drop_all_null(df).count() == 0


def test_string_cleaning(spark):
    df = spark.createDataFrame([(1, " Inlet PIPE ", 3, NOW), (2, "Ärmel", 4, NOW)], COLS)
    names = {r["name"] for r in rows(C.clean_records(df))}
    assert names == {"inlet pipe", "ärmel"}


def test_trim_is_spaces_only(spark):
    df = spark.createDataFrame([("\tA ",)], "name string")
    assert C.clean_strings(df).first()["name"] == "\ta"


def test_negative_values_removed(spark):
    df = spark.createDataFrame([(1, "a", 100, NOW), (2, "b", -50, NOW), (3, "c", 150, NOW)], COLS)
    out = rows(C.clean_records(df))
    assert len(out) == 2 and all(r["value"] > 0 for r in out)


def test_nan_dropped_by_default_and_kept_on_request(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 5.0), (3, None)], "id int, value double")
    assert [r["id"] for r in rows(C.filter_positive(df), ["id"])] == [2]
    assert [r["id"] for r in rows(C.filter_positive(df, nan="keep"), ["id"])] == [1, 2]


def test_duplicates_removed(spark):
    df = spark.createDataFrame([(i % 3, f"part {i % 3}", 10 + i % 3, NOW) for i in range(9)], COLS)
    assert C.clean_records(df).count() == 3


def test_case_variants_collapse_after_cleaning(spark):
    df = spark.createDataFrame([(1, " A ", 5, NOW), (1, "a", 5, NOW)], COLS)
    assert C.clean_records(df).count() == 1


def test_dedup_ignores_lineage_stamps(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (1, "a", dt.datetime(2024, 1, 2))],
                               "id int, name string, extraction_timestamp timestamp")
    assert C.dedup(df).count() == 1


def _dirty_five(spark):
    return spark.createDataFrame(FAULTY_ROWS, COLS)


def test_dirty_pipeline_keeps_null_name_by_default(spark):
    out = E.enrich_records(C.clean_records(_dirty_five(spark)))
    assert out.count() == 3


def test_dirty_pipeline_with_required_name(spark):
    out = rows(E.enrich_records(C.clean_records(_dirty_five(spark), required_columns=["name"])))
    assert len(out) == 2
    for r in out:
        assert r["value"] > 0 and r["name"] == r["name"].lower().strip() and r["value_category"]


def test_clean_is_idempotent(spark):
    once = C.clean_records(_dirty_five(spark))
    twice = C.clean_records(once)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_fill_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (3, float("nan"))], "id int, value double")
    assert [r["value"] for r in rows(C.fill_numeric(df), ["id"])] == [0.0, 3.0, 0.0]


def test_enrich_bands_and_parts(spark, sample_df):
    out = rows(E.enrich_records(sample_df), ["id"])
    assert {r["id"]: r["value_category"] for r in out} == SAMPLE_BANDS
    assert [(r["year"], r["month"], r["day"]) for r in out] == [(2023, 11, 30), (2023, 12, 1), (2024, 2, 29), (2024, 2, 29), (2024, 3, 1)]
    assert len({r["name_hash"] for r in out}) == 5
    assert all(r["processing_version"] == "1.0" and r["processed_timestamp"] is not None for r in out)


def test_band_of_null_and_nan_is_high(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 99.99)], "id int, value double")
    assert [r["value_category"] for r in rows(E.add_band(df), ["id"])] == ["high", "high", "low"]


def test_band_counts_of_a_range(spark):
    df = spark.range(1, 301).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("value"), F.lit(NOW).alias("timestamp"))
    out = E.enrich_records(C.clean_records(df)).groupBy("value_category").count()
    assert dict(out.collect()) == {"low": 99, "medium": 100, "high": 101}


def test_hash_is_spark_murmur3(spark):
    df = spark.createDataFrame([("a",), (None,)], "name string")
    got = [r["name_hash"] for r in E.add_hash(df).collect()]
    assert got == [1485273170, 42]
    assert dict(E.add_hash(df).dtypes)["name_hash"] == "bigint"


def test_sha256_and_standard_names(spark):
    df = spark.createDataFrame([(7, "x")], "CustomerID int, MonthlyCharges string")
    out = E.standardize_columns(E.anonymize_sha256(df, ["CustomerID"]))
    assert out.columns == ["customer_id", "monthly_charges"]
    assert out.first()["customer_id"] == "7902699be42c8a8e46fbbb4501726517e86b22c56a189f7625a6da49081b2451"
    assert snake_case("Customer ID") == "customer_id" and snake_case("TotalCharges") == "total_charges"


def test_stamp_timestamp_as_of_is_ntz(spark, sample_df):
    out = E.stamp_timestamps(sample_df, ["load_timestamp"], as_of="2024-02-01 00:00:00")
    assert dict(out.dtypes)["load_timestamp"] == "timestamp_ntz"
    assert out.first()["load_timestamp"] == dt.datetime(2024, 2, 1)


def test_sql_transform_differs_as_documented(spark):
    df = _dirty_five(spark)
    sql = transform_sql(df)
    assert sql.count() == 3  # no dedup, null name and negative value dropped
    assert "day" not in sql.columns
    raw_hash = sql.where(F.col("id") == 21).select("name_hash").first()[0]
    assert raw_hash == spark.range(1).select(F.hash(F.lit(FAULTY_ROWS[0][1])).cast("bigint")).first()[0]
