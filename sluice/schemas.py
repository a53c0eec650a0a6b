"""Declared table shapes.

Timestamps are ``TIMESTAMP_NTZ`` throughout: the target tables store wall-clock
times without a zone, the driver's Parquet arrives as NTZ, and NTZ keeps date
parts independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The record shape every transform/load step works on.
RECORD_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.IntegerType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

# Lineage columns stamped by extract, transform, load and summary.
EXTRACTION_TS = "extraction_timestamp"
SOURCE_SYSTEM = "source_system"
PROCESSED_TS = "processed_timestamp"
PROCESSING_VERSION = "processing_version"
LOAD_TS = "load_timestamp"
SUMMARY_TS = "summary_timestamp"
METADATA_COLUMNS = (EXTRACTION_TS, SOURCE_SYSTEM, PROCESSED_TS, PROCESSING_VERSION, LOAD_TS, SUMMARY_TS)

# Target table ``processed_data`` (14 columns, in this order).
# ``value`` is NUMERIC in the target; double keeps int and double inputs exact.
# ``id`` is BIGINT: record ids pass 2^31 at the sizes this is meant for.
PROCESSED_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField(EXTRACTION_TS, T.TimestampNTZType(), True),
    T.StructField(SOURCE_SYSTEM, T.StringType(), True),
    T.StructField(PROCESSED_TS, T.TimestampNTZType(), True),
    T.StructField(PROCESSING_VERSION, T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("value_category", T.StringType(), True),
    T.StructField("name_hash", T.LongType(), True),
    T.StructField(LOAD_TS, T.TimestampNTZType(), True),
])

# Target table ``daily_summary``.
DAILY_SUMMARY_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("value_category", T.StringType(), True),
    T.StructField("record_count", T.LongType(), True),
    T.StructField("avg_value", T.DoubleType(), True),
    T.StructField("min_value", T.DoubleType(), True),
    T.StructField("max_value", T.DoubleType(), True),
    T.StructField(SUMMARY_TS, T.TimestampNTZType(), True),
])

# The churn extract's expected column names, label and numeric columns.
CHURN_COLUMNS = (
    "CustomerID", "Age", "Gender", "Tenure", "MonthlyCharges",
    "ContractType", "InternetService", "TotalCharges", "TechSupport", "Churn",
)
CHURN_LABEL = "Churn"
CHURN_NUMERIC = ("Age", "Tenure", "MonthlyCharges", "TotalCharges")

CHURN_SCHEMA = T.StructType([
    T.StructField("CustomerID", T.IntegerType(), True),
    T.StructField("Age", T.IntegerType(), True),
    T.StructField("Gender", T.StringType(), True),
    T.StructField("Tenure", T.IntegerType(), True),
    T.StructField("MonthlyCharges", T.DoubleType(), True),
    T.StructField("ContractType", T.StringType(), True),
    T.StructField("InternetService", T.StringType(), True),
    T.StructField("TotalCharges", T.DoubleType(), True),
    T.StructField("TechSupport", T.StringType(), True),
    T.StructField("Churn", T.StringType(), True),
])

# Source table ``raw_data.sample_source`` column names.
SAMPLE_SOURCE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("customer_name", T.StringType(), True),
    T.StructField("transaction_value", T.DoubleType(), True),
    T.StructField("transaction_date", T.TimestampNTZType(), True),
    T.StructField("source", T.StringType(), True),
])

