from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from sluice.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# Five records (id, name, value, timestamp) at and beside the bounds of the value bands.
SAMPLE_ROWS = [
    (11, "pump", 99, dt.datetime(2023, 11, 30, 23, 59)),
    (12, "valve", 100, dt.datetime(2023, 12, 1, 0, 0)),
    (13, "gasket", 199, dt.datetime(2024, 2, 29, 6, 5)),
    (14, "flange", 200, dt.datetime(2024, 2, 29, 6, 6)),
    (15, "rotor", 1, dt.datetime(2024, 3, 1, 12, 0)),
]
SAMPLE_BANDS = {11: "low", 12: "medium", 13: "medium", 14: "high", 15: "low"}

# Rows with one fault each: copies that differ in case and padding only, a value below zero, no name.
FAULTY_ROWS = [
    (21, " Steam Valve", 120, dt.datetime(2024, 2, 27)),
    (22, "pump", -7, dt.datetime(2024, 2, 28)),
    (23, None, 33, dt.datetime(2024, 2, 29)),
    (21, " Steam Valve", 120, dt.datetime(2024, 2, 27)),
    (24, "ROTOR ", 450, dt.datetime(2024, 3, 1)),
]

RECORD_SCHEMA_TZ = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("value", T.IntegerType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])


@pytest.fixture(scope="session")
def spark():
    # The checkpoint folder comes from the environment when configured;
    # build_session creates a local one only if it is unset.
    session = build_session("sluice-tests", master="local[*]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sluice-test-")


@pytest.fixture()
def sample_df(spark):
    return spark.createDataFrame(SAMPLE_ROWS, RECORD_SCHEMA_TZ)


def rows(df, order=None):
    data = [r.asDict() for r in df.collect()]
    if order:
        data.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return data
