"""Profiles, reports and load gates."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import impute as I
from sluice.operators import quality as Q
from sluice.operators.summarize import daily_summary
from sluice.schemas import CHURN_COLUMNS
from tests.conftest import rows

COLS = ["id", "name", "value", "timestamp"]
NOW = dt.datetime(2024, 1, 1)


def test_quality_report_on_sample(sample_df):
    rep = Q.quality_summary(sample_df, "sample")
    assert (rep["total_rows"], rep["distinct_rows"], rep["duplicates"]) == (5, 5, 0)
    assert rep["null_counts"] == {"id": 0, "name": 0, "value": 0, "timestamp": 0}


def test_quality_report_nulls(spark):
    df = spark.createDataFrame([(1, None, None, NOW), (None, None, 5, NOW), (3, "seal", None, None), (4, "", 0, NOW)], COLS)
    rep = Q.quality_summary(df)
    assert rep["total_rows"] == 4 and rep["null_counts"] == {"id": 1, "name": 2, "value": 2, "timestamp": 1}


def test_quality_report_duplicates(spark):
    df = spark.createDataFrame([(7, "cam", 5, NOW)] * 3 + [(7, "cam", 6, NOW), (8, None, 5, NOW), (8, None, 5, NOW)], COLS)
    rep = Q.quality_summary(df)
    assert (rep["total_rows"], rep["distinct_rows"], rep["duplicates"]) == (6, 3, 3)
    assert rep["duplicate_pct"] == 50.0 and rep["null_pct"]["name"] == 33.33


def test_quality_report_counts_nan_and_handles_timestamps(spark):
    df = spark.createDataFrame([(1, float("nan"), NOW), (2, 1.0, None)], "id int, v double, ts timestamp")
    row = Q.quality_report(df).first()
    assert row["missing_v"] == 1 and row["missing_ts"] == 1


def test_quality_report_empty(spark):
    df = spark.createDataFrame([], "id int, name string")
    row = Q.quality_report(df).first()
    assert (row["total_rows"], row["distinct_rows"], row["duplicates"], row["missing_id"]) == (0, 0, 0, 0)


def test_missing_profile_and_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, float("nan")), (3, 2.0), (4, 1.0)], "a int, b double")
    prof = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in Q.missing_profile(df).collect()}
    assert prof == {"a": (1, 25.0), "b": (2, 50.0)}
    assert Q.null_counts(df).first().asDict() == {"a": 1, "b": 1}


def test_group_counts_and_describe(spark):
    df = spark.createDataFrame([("Yes", 1.0), ("No", 2.0), ("No", 4.0)], "Churn string, x double")
    assert {r["Churn"]: r["count"] for r in Q.group_counts(df, "Churn").collect()} == {"Yes": 1, "No": 2}
    d = Q.describe(df, ["x"]).first()
    assert (d["count"], d["min"], d["max"]) == (3, 1.0, 4.0)
    assert math.isclose(d["mean"], 7 / 3) and math.isclose(d["stddev"], math.sqrt(7 / 3))
    e = Q.describe(df, ["x"], exact_scale=2).first()
    assert math.isclose(e["mean"], 7 / 3) and math.isclose(e["stddev"], math.sqrt(7 / 3))


def test_duplicate_profile(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "a int")
    r = Q.duplicate_profile(df).first()
    assert (r["total_rows"], r["distinct_rows"], r["duplicate_rows"], r["duplicate_pct"]) == (4, 2, 2, 50.0)


def test_expected_columns_report(spark):
    df = spark.createDataFrame([(1, "F")], "CustomerID int, Gender string")
    rep = {r["column_name"]: r["present"] for r in Q.expected_columns_report(df, CHURN_COLUMNS).collect()}
    assert rep["CustomerID"] and rep["Gender"] and not rep["Churn"]
    assert Q.missing_columns(df, CHURN_COLUMNS) == [c for c in CHURN_COLUMNS if c not in ("CustomerID", "Gender")]
    typed = Q.expected_columns_report(df, T.StructType([T.StructField("CustomerID", T.LongType())])).first()
    assert typed["present"] and not typed["type_ok"]


def test_validate_for_load(spark, sample_df):
    assert Q.validate_for_load(sample_df) is True
    empty = spark.createDataFrame([], "id int, name string, value int, timestamp timestamp")
    assert Q.validate_for_load(empty) is False
    assert Q.validate_for_load(spark.createDataFrame([(1, "a")], "id int, name string")) is False
    with_null_id = spark.createDataFrame([(None, "a", 1, NOW), (2, "b", 2, NOW)], COLS)
    assert Q.validate_for_load(with_null_id) is True


def test_ensure_nonempty(spark):
    with pytest.raises(ValueError):
        Q.ensure_nonempty(spark.createDataFrame([], "a int"), "stage")


def test_frames_diff(spark, sample_df):
    assert Q.frames_equal(sample_df, sample_df.select(*reversed(sample_df.columns)).select(*sample_df.columns))
    other = sample_df.where("id <> 15")
    diff = rows(Q.frames_diff(sample_df, other))
    assert len(diff) == 1 and diff[0]["side"] == "left_only" and diff[0]["copies"] == 1
    tripled = sample_df.unionByName(sample_df).unionByName(sample_df.where("id = 11"))
    diff = rows(Q.frames_diff(sample_df, tripled), ["id"])
    assert [(r["id"], r["side"], r["copies"]) for r in diff] == [
        (11, "right_only", 2), (12, "right_only", 1), (13, "right_only", 1), (14, "right_only", 1), (15, "right_only", 1)]


def test_approx_quality_report(spark):
    df = spark.range(0, 2000).selectExpr("id % 1000 as a", "case when id % 10 = 0 then null else id end as b")
    rep = Q.quality_summary(df, approx_rsd=0.01)
    assert rep["total_rows"] == 2000 and rep["null_counts"]["b"] == 200
    exact = Q.quality_summary(df)["distinct_rows"]
    assert exact == 1900 and abs(rep["distinct_rows"] - exact) <= 0.04 * exact


def test_approx_duplicate_profile(spark):
    df = spark.range(0, 2000).selectExpr("id % 1000 as a")
    r = Q.duplicate_profile(df, approx_rsd=0.01).first()
    assert r["total_rows"] == 2000 and abs(r["distinct_rows"] - 1000) <= 40


def test_exact_median_matches_numpy_with_forced_narrowing(spark):
    rnd = random.Random(7)
    vals = [round(rnd.gauss(50, 20), 2) for _ in range(5001)] + [None] * 10 + [12.5] * 300
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    present = sorted(v for v in vals if v is not None)
    for q in (0.5, 0.1, 0.93):
        pos = q * (len(present) - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        want = (1 - (pos - lo)) * present[lo] + (pos - lo) * present[hi]
        assert I.exact_quantile(df, "v", q, accuracy=50) == pytest.approx(want, abs=0, rel=0)


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (None, "b", 5.0), (4, None, float("nan"))],
                               "id int, name string, v double")
    out = rows(I.impute(df, {"v": "median", "name": "mode", "id": ("constant", -1)}), ["v", "id"])
    assert [r["v"] for r in out] == [1.0, 3.0, 3.0, 5.0]
    assert {r["name"] for r in out} == {"a", "b"} and all(r["name"] for r in out)
    assert -1 in {r["id"] for r in out}
    mean = rows(I.impute(df, {"v": "mean"}), ["id"])
    assert sorted(r["v"] for r in mean) == [1.0, 3.0, 3.0, 5.0]


def test_exact_daily_average_is_partition_independent(spark):
    rnd = random.Random(3)
    vals = [round(rnd.uniform(0.01, 500.0), 2) for _ in range(20_000)]
    base = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, value double")
    results = set()
    for parts in (1, 7, 29):
        shuffled = base.repartition(parts, F.rand(parts)).sortWithinPartitions(F.rand(parts + 1))
        out = daily_summary(shuffled, keys=("g",), with_timestamp=False, exact_scale=2)
        results.add(tuple(sorted((r["g"], r["avg_value"]) for r in out.collect())))
    assert len(results) == 1
    want = {g: float(sum(Decimal(str(v)) for i, v in enumerate(vals) if i % 3 == g)) / sum(1 for i in range(len(vals)) if i % 3 == g)
            for g in range(3)}
    assert dict(results.pop()) == want
