"""Expectations measured on the driver tables and the documented fixtures."""

from __future__ import annotations

import datetime as dt


from sluice.operators import clean as C
from sluice.operators import enrich as E
from sluice.operators import quality as Q
from sluice.operators.modeling import churn_profile, validate_churn
from sluice.plans.flows import transform_sql
from sluice.schemas import CHURN_LABEL, CHURN_NUMERIC, CHURN_SCHEMA, SAMPLE_SOURCE_SCHEMA
from sluice.sinks.files import write_csv
from sluice.sources.derived import churn_frame, dirty_records, events_as_records, to_records
from sluice.sources.files import read_csv
from tests.conftest import SF_ORACLE, rows


def test_dirty_events_counts_at_sf001(spark):
    events = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    dirty = dirty_records(events)
    rep = Q.quality_summary(dirty)
    assert rep["total_rows"] == 10_200 and rep["distinct_rows"] == 9_901
    assert rep["null_counts"]["id"] == 102 and rep["null_counts"]["name"] == 1_544
    assert C.clean_records(dirty).count() == 7_818
    assert transform_sql(dirty).count() == 6_835


def test_clean_events_have_no_faults_and_known_bands(spark):
    recs = events_as_records(spark.read.parquet(f"{SF_ORACLE}/events.parquet"))
    rep = Q.quality_summary(recs)
    assert rep["total_rows"] == rep["distinct_rows"] == 10_000 and sum(rep["null_counts"].values()) == 0
    bands = {r["value_category"]: r["count"] for r in Q.group_counts(E.add_band(recs), "value_category").collect()}
    assert bands == {"low": 8_683, "medium": 1_145, "high": 172}
    assert C.filter_positive(spark.read.parquet(f"{SF_ORACLE}/customer.parquet"), "c_acctbal").count() == 1_500 - 122


def test_sample_source_rows(spark):
    src = spark.createDataFrame([
        (1, "Customer A", 150.50, dt.datetime(2024, 1, 15, 10, 0), "web"),
        (2, "Customer B", 75.25, dt.datetime(2024, 1, 15, 11, 0), "mobile"),
        (3, "Customer C", 300.00, dt.datetime(2024, 1, 15, 12, 0), "web"),
        (4, "Customer D", 45.75, dt.datetime(2024, 1, 15, 13, 0), "store"),
        (5, "Customer E", 220.80, dt.datetime(2024, 1, 15, 14, 0), "web"),
    ], SAMPLE_SOURCE_SCHEMA)
    recs = to_records(src, id="id", name="customer_name", value="transaction_value", timestamp="transaction_date")
    out = rows(E.enrich_records(C.clean_records(recs)), ["id"])
    assert [r["value_category"] for r in out] == ["medium", "low", "high", "low", "high"]
    assert [r["name"] for r in out][:2] == ["customer a", "customer b"]


def test_churn_csv_profile(spark, tmp_dir):
    data = [
        (1, 34, "Female", 12, 70.5, "Month-to-month", "Fiber optic", 846.0, "No", "Yes"),
        (2, 51, "Male", 40, 55.25, "One year", "DSL", 2210.0, "Yes", "No"),
        (3, None, "Male", 3, 20.0, "Month-to-month", "No", None, "No", "Yes"),
        (4, 29, None, 60, 99.9, "Two year", "Fiber optic", 5994.0, "Yes", "No"),
    ]
    df = spark.createDataFrame(data, CHURN_SCHEMA)
    write_csv(df, f"{tmp_dir}/churn.csv")
    back = read_csv(spark, f"{tmp_dir}/churn.csv")  # inferred types, like the extract step
    assert not Q.missing_columns(back, CHURN_SCHEMA.fieldNames())
    prof = {(r["metric"], r["key"]): r["n"] for r in churn_profile(back, CHURN_LABEL, back.columns).collect()}
    assert prof[("label", "Yes")] == 2 and prof[("label", "No")] == 2
    assert prof[("null_count", "Age")] == 1 and prof[("null_count", "TotalCharges")] == 1
    desc = {r["column_name"]: r for r in Q.describe(back, CHURN_NUMERIC).collect()}
    assert desc["Age"]["count"] == 3 and desc["Tenure"]["max"] == 60.0
    assert dict(back.dtypes)["MonthlyCharges"] == "double"
    report = validate_churn(back.drop("TechSupport"), CHURN_SCHEMA.fieldNames(), CHURN_LABEL, CHURN_NUMERIC)
    assert report["missing_columns"] == ["TechSupport"]
    assert report["labels"] == {"Yes": 2, "No": 2} and report["null_counts"]["Gender"] == 1
    assert report["stats"]["Tenure"]["min"] == 3.0


def test_churn_frame_by_hand(spark):
    customer = spark.createDataFrame([(1, "A", 0, 10.0, "BUILDING"), (2, "B", 1, 5.0, "MACHINERY"),
                                      (3, "C", 0, 1.0, "BUILDING")],
                                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    nation = spark.createDataFrame([(0, "FRANCE", 0), (1, "JAPAN", 1)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(0, "EUROPE"), (1, "ASIA")], "r_regionkey int, r_name string")
    orders = spark.createDataFrame([
        (10, 1, "F", 100.10, dt.datetime(2020, 1, 1), "1-URGENT"),
        (11, 1, "F", 200.20, dt.datetime(2022, 6, 1), "5-LOW"),   # last order in the data
        (12, 2, "F", 50.00, dt.datetime(2020, 3, 1), "5-LOW"),    # > 365 days before 2022-06-01
    ], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
       "o_orderdate timestamp_ntz, o_orderpriority string")
    got = {r["CustomerID"]: r.asDict() for r in churn_frame(customer, orders, nation, region).collect()}
    one, two, three = got[1], got[2], got[3]
    # 2020-01-01 .. 2022-06-01 is 882 days -> 882 div 30 + 1 = 30 months
    assert (one["Tenure"], one["TotalCharges"], one["Churn"]) == (30, 300.3, "No")
    assert one["MonthlyCharges"] == 300.3 / 30
    assert (one["UrgentService"], one["LowService"], one["HighService"]) == ("Yes", "Yes", "No")
    assert (one["Nation"], one["Region"], one["ContractType"]) == ("FRANCE", "EUROPE", "BUILDING")
    assert (two["Tenure"], two["Churn"], two["Region"]) == (1, "Yes", "ASIA")
    assert (three["Tenure"], three["TotalCharges"], three["MonthlyCharges"], three["Churn"]) == (0, None, None, "Yes")
