"""Views of the driver's tables in the shapes the operators expect.

* ``events`` -> record shape ``(id, name, value, timestamp)``;
* ``dirty_records``: the same rows with deterministic faults injected (padding,
  upper case, NULLs, negatives, all-NULL rows, repeated rows) - every input row
  is kept, and two percent are repeated;
* ``churn_frame``: a per-customer churn table derived from ``customer`` and
  ``orders`` (label: no order in the last 365 days of the data).

All are lazy DataFrames over the whole input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import exact_sum

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_records(events: DataFrame) -> DataFrame:
    """``id=event_id, name=event_type, value=value, timestamp=ts``."""
    return to_records(events, id="event_id", name="event_type", value="value", timestamp="ts")


def to_records(df: DataFrame, id: str, name: str, value: str, timestamp: str) -> DataFrame:
    """Project any source onto the record shape by naming its four columns."""
    return df.select(F.col(id).alias("id"), F.col(name).alias("name"),
                     F.col(value).alias("value"), F.col(timestamp).alias("timestamp"))


def dirty_records(events: DataFrame) -> DataFrame:
    """Record-shaped rows with faults chosen by ``event_id``.

    Fixed values (fault rules): id % 101 = 0 -> whole row NULL; id % 7 = 0 ->
    NULL name; id % 3 = 0 -> name upper-cased and padded; id % 13 = 0 -> NULL
    value; id % 17 = 0 -> NaN; id % 11 = 0 -> negated value; id % 19 = 0 ->
    negated id; id % 23 = 0 -> NULL timestamp; id % 4 -> that many months
    later; id % 50 = 0 -> row appears twice.
    """
    e = F.col("event_id")
    dead = (e % 101) == 0
    copies = F.when((e % 50) == 0, F.lit(2)).otherwise(F.lit(1))
    # one scan: each row is emitted ``copies`` times by a generator
    doubled = events.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("__copy"))
    return doubled.select(
        F.when(dead, F.lit(None)).when((e % 19) == 0, -e).otherwise(e).alias("id"),
        F.when(dead | ((e % 7) == 0), F.lit(None))
         .when((e % 3) == 0, F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")))
         .otherwise(F.col("event_type")).alias("name"),
        F.when(dead | ((e % 13) == 0), F.lit(None))
         .when((e % 17) == 0, F.lit(float("nan")))
         .when((e % 11) == 0, -F.col("value"))
         .otherwise(F.col("value")).alias("value"),
        F.when(dead | ((e % 23) == 0), F.lit(None))
         .otherwise(F.col("ts") + F.make_interval(months=(e % 4).cast("int"))).alias("timestamp"),
    )


# Order priorities, read as the "services" a customer uses.
SERVICE_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SERVICE_COLUMNS = ("UrgentService", "HighService", "MediumService", "UnspecifiedService", "LowService")
CHURN_WINDOW_DAYS = 365


def churn_frame(customer: DataFrame, orders: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One row per customer:

    ``CustomerID, Tenure, MonthlyCharges, TotalCharges, ContractType, Nation,
    Region, <service flags Yes/No>, Churn``.

    Orders are aggregated per customer before the join (one partial+final
    aggregate), so the customer join shuffles one row per customer on each
    side.  The data's last order date is a scalar subquery, not a join.
    """
    as_of = orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    pri = F.col("o_orderpriority")
    per_customer = orders.groupBy(F.col("o_custkey").alias("CustomerID")).agg(
        F.min(F.to_date("o_orderdate")).alias("first_order"),
        F.max(F.to_date("o_orderdate")).alias("last_order"),
        exact_sum("o_totalprice").alias("TotalCharges"),
        *[F.max(F.when(pri == p, F.lit(1)).otherwise(F.lit(0))).alias(s)
          for p, s in zip(SERVICE_PRIORITIES, SERVICE_COLUMNS)],
    )
    # Plain joins: Spark's statistics and adaptive execution choose the broadcasts.
    geo = nation.select(F.col("n_nationkey"), F.col("n_name").alias("Nation"), F.col("n_regionkey")).join(
        region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("Region")),
        on="n_regionkey", how="left",
    ).drop("n_regionkey")
    # Fixed values (awkward keys): no contract where the key is divisible by 29, a separator in it by 31.
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    contract = F.when(key % 29 == 0, F.lit(None)).when(key % 31 == 0, F.concat(segment, F.lit("|"), segment)).otherwise(segment)
    cust = customer.select(
        F.col("c_custkey").alias("CustomerID"), contract.alias("ContractType"),
        F.col("c_nationkey").alias("n_nationkey"),
    ).join(geo, on="n_nationkey", how="left").drop("n_nationkey")
    tenure = F.when(F.col("first_order").isNull(), F.lit(0)).otherwise(
        (F.expr("datediff(last_order, first_order) div 30") + 1).cast("int"))
    joined = cust.join(per_customer, on="CustomerID", how="left")
    return joined.select(
        F.col("CustomerID"),
        tenure.alias("Tenure"),
        F.try_divide(F.col("TotalCharges"), tenure.cast("double")).alias("MonthlyCharges"),
        F.col("TotalCharges"),
        F.col("ContractType"),
        F.col("Nation"),
        F.col("Region"),
        *[F.when(F.col(s) == 1, F.lit("Yes")).otherwise(F.lit("No")).alias(s) for s in SERVICE_COLUMNS],
        F.when(F.col("last_order").isNull() | (F.datediff(as_of, F.col("last_order")) > CHURN_WINDOW_DAYS),
               F.lit("Yes")).otherwise(F.lit("No")).alias("Churn"),
    )
