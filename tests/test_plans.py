"""Physical-plan checks: pushdown, pruning, exchanges, no Python in the hot path."""

from __future__ import annotations

from sluice.operators import quality as Q
from sluice.operators.clean import clean_records
from sluice.plans import catalog
from sluice.sinks.files import write_bucketed
from sluice.sources.derived import dirty_records
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df) -> int:
    return plan(df).count("Exchange hashpartitioning") + plan(df).count("Exchange SinglePartition")


def test_clean_filter_is_pushed_to_scan(spark):
    df = catalog.QUERIES["pipe_clean"](spark, SF_SMALL)
    text = plan(df)
    assert "PushedFilters" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_flagship_prunes_columns_and_shuffles_twice_at_most(spark):
    df = catalog.QUERIES["agg_daily_summary"](spark, SF_SMALL)
    text = plan(df)
    assert "GreaterThan(value,0.0)" in text
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]
    # one shuffle for the de-duplication, one for the summary
    assert exchanges(df) <= 2
    assert "PythonUDF" not in text and "BatchEvalPython" not in text


def test_projection_reads_only_needed_columns(spark):
    df = catalog.QUERIES["project_columns"](spark, SF_SMALL)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan(df)


def test_quality_report_is_one_job_shape(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    df = Q.quality_report(events)
    # group by every column (one exchange) + global reduction (one)
    assert exchanges(df) == 2
    assert "partial_count" in plan(df)


def test_churn_queries_build_without_jobs(spark):
    group = "churn-build"
    spark.sparkContext.setJobGroup(group, group)
    for name in ("doc_tenure_bucket", "doc_dim_contract", "doc_fact", "doc_churn_summary"):
        catalog.QUERIES[name](spark, SF_SMALL)
    # reading a Parquet footer for its schema is a job of its own; none other runs
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4 * 4
    assert "rebalance" not in plan(catalog.QUERIES["doc_fact"](spark, SF_SMALL)).lower()


def test_stamped_rows_are_deduplicated_in_one_exchange(spark):
    text = plan(catalog.QUERIES["dedup_rows_stamped"](spark, SF_SMALL))
    # all stamps of a row come from one copy, chosen before and after the one exchange
    assert text.count("Exchange hashpartitioning(id") == 1 and "partial_min(struct" in text and "collect_set" not in text


def test_no_python_udfs_anywhere(spark):
    for name, build in catalog.QUERIES.items():
        text = optimized(build(spark, SF_SMALL))
        assert "PythonUDF" not in text, name


def test_bucketed_table_dedups_without_exchange(spark, tmp_dir):
    dirty = dirty_records(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    assert write_bucketed(dirty, "dirty_bucketed_t", by=["id"], buckets=4, path=f"{tmp_dir}/b") == dirty.count()
    try:
        cleaned = clean_records(spark.table("dirty_bucketed_t"))
        assert exchanges(cleaned) == 0
        assert cleaned.count() == clean_records(dirty).count()
    finally:
        spark.sql("DROP TABLE IF EXISTS dirty_bucketed_t")


def test_the_whole_load_comes_back_and_a_year_prunes(spark):
    whole = catalog.QUERIES["pipe_load_whole"](spark, SF_SMALL)
    rows = catalog.E.enrich_records(catalog.C.clean_records(catalog.discounts(spark, SF_SMALL)), as_of=catalog.AS_OF, with_hash=False)
    assert whole.count() == rows.count() > whole.where("year <= 1998").count()
    part = catalog.QUERIES["pipe_load_partitioned"](spark, SF_SMALL).where("year <= 1998")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
