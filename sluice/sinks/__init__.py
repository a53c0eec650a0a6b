"""Writers: Parquet, partitioned Parquet, CSV exports and JDBC."""

from sluice.sinks.files import (
    observed, run_id, run_output_path, write_bucketed, write_csv, write_parquet, write_partitioned,
)
from sluice.sinks.jdbc import create_table_jdbc, table_exists_jdbc, write_jdbc

__all__ = [n for n in dir() if not n.startswith("_")]
