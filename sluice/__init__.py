"""sluice: Spark-native batch data preparation.

Schema-aware reading (CSV, Parquet, JDBC), one-pass profiling and quality
reports, rule-driven cleaning, enrichment, grouped daily summaries and
idempotent partitioned loading - each a plain ``DataFrame -> DataFrame``
function built from Spark expressions.
"""

__version__ = "0.1.0"
