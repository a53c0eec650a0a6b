"""Hot keys: a third of all rows in one group must not land in one task."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from sluice.operators import clean as C
from sluice.operators import quality as Q
from sluice.sinks.files import write_partitioned


def _hot(spark, n=300_000):
    # one (year, month) holds a third of the rows; the rest spread over 24 months
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(2024)).otherwise(F.lit(2020) + (F.col("id") % 4)).alias("year"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.lit(1) + (F.col("id") % 12)).alias("month"),
        (F.col("id") * 7 % 1000).cast("double").alias("value"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def test_hot_partition_is_split_across_writers(spark, tmp_dir):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        df = _hot(spark)
        assert write_partitioned(df, f"{tmp_dir}/t") == 300_000
    finally:
        spark.conf.set(key, old)
    hot = [f for f in os.listdir(f"{tmp_dir}/t/year=2024/month=1") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 300_000


def test_hot_copies_collapse_before_the_shuffle(spark):
    # a third of the rows are copies of one row: distinct and the report stay exact
    base = spark.range(200_000).select((F.col("id") % 1000).alias("a"))
    hot = spark.range(100_000).select(F.lit(-1).cast("bigint").alias("a"))
    df = base.unionByName(hot)
    rep = Q.quality_summary(df)
    assert (rep["total_rows"], rep["distinct_rows"]) == (300_000, 1_001)
    assert C.dedup(df).count() == 1_001
    plan = Q.quality_report(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
