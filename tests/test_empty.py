"""Every operator accepts an empty input (a day with no data)."""

from __future__ import annotations

from sluice.operators import clean as C
from sluice.operators import enrich as E
from sluice.operators import modeling as M
from sluice.operators import quality as Q
from sluice.operators.conform import conform_to_schema
from sluice.operators.impute import exact_quantile, impute
from sluice.operators.summarize import daily_summary
from sluice.plans.flows import transform_sql
from sluice.schemas import PROCESSED_SCHEMA

DDL = "id bigint, name string, value double, timestamp timestamp_ntz"


def test_empty_inputs(spark):
    df = spark.createDataFrame([], DDL)
    assert C.clean_records(df).count() == 0
    enriched = E.enrich_records(C.clean_records(df))
    assert daily_summary(enriched).count() == 0
    assert conform_to_schema(enriched, PROCESSED_SCHEMA).count() == 0
    assert transform_sql(df).count() == 0
    rep = Q.quality_summary(df)
    assert (rep["total_rows"], rep["distinct_rows"], rep["duplicates"]) == (0, 0, 0)
    assert {r["column_name"]: r["missing_count"] for r in Q.missing_profile(df).collect()}["value"] == 0
    d = Q.describe(df, ["value"]).first()
    assert d["count"] == 0 and d["mean"] is None and d["stddev"] is None
    assert Q.duplicate_profile(df).first()["duplicate_pct"] is None
    assert Q.group_counts(df, "name").count() == 0
    assert exact_quantile(df, "value") is None
    assert impute(df, {"value": "median", "name": "mode"}).count() == 0
    assert M.quality_score(df, M.record_rules()).count() == 0
    assert Q.frames_equal(df, df)
    assert Q.quality_report_by(df.withColumn("dataset", df.name), "dataset").count() == 0
