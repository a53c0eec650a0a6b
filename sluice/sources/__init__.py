"""Readers: files, JDBC, and views of the driver's tables."""

from sluice.sources.files import (
    CSV_TIMESTAMP_FORMAT, CSV_TIMESTAMP_FORMAT_MICROS, discover_datasets, list_children, literal_table,
    path_exists, read_csv, read_or_empty, read_parquet, with_source_file,
)
from sluice.sources.jdbc import jdbc_bounds, jdbc_config_from_env, modulo_predicates, read_jdbc

__all__ = [n for n in dir() if not n.startswith("_")]
