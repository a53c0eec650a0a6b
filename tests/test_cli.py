"""The command line runs the daily steps in the caller's session."""

from __future__ import annotations

import datetime as dt

from sluice.__main__ import main
from sluice.schemas import RECORD_SCHEMA
from sluice.sinks.files import write_csv
from sluice.sources.files import CSV_TIMESTAMP_FORMAT_MICROS

DDL = "id int, name string, value int, timestamp timestamp_ntz"


def test_cli_steps(spark, tmp_dir):
    rows = [(1, " A ", 150, dt.datetime(2024, 1, 15)), (2, "b", -1, dt.datetime(2024, 1, 15)),
            (1, " A ", 150, dt.datetime(2024, 1, 15)), (3, "c", 50, dt.datetime(2024, 1, 16))]
    write_csv(spark.createDataFrame(rows, RECORD_SCHEMA), f"{tmp_dir}/in.csv", timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    common = ["--as-of", "2024-02-01 00:00:00", "--run-id", "r1"]
    assert main(["extract", "--input", f"{tmp_dir}/in.csv", "--schema", DDL, "--raw", f"{tmp_dir}/raw", *common])["rows"] == 4
    assert main(["report", "--input", f"{tmp_dir}/raw/extracted_data_csv_r1"])["duplicates"] == 1
    assert main(["transform", "--raw", f"{tmp_dir}/raw", "--processed", f"{tmp_dir}/proc", *common])["rows"] == 2
    batched = main(["transform", "--batched", "--raw", f"{tmp_dir}/raw", "--processed", f"{tmp_dir}/batched", *common])
    assert batched["rows"] == 2 and batched["datasets"] == ["extracted_data_csv_r1"]
    assert main(["load", "--processed", f"{tmp_dir}/proc", "--target", f"{tmp_dir}/wh", *common])["rows"] == 2
    assert main(["summary", "--table", f"{tmp_dir}/wh", "--out", f"{tmp_dir}/sum", *common])["rows"] == 2
    assert main(["load", "--processed", f"{tmp_dir}/batched", "--target", f"{tmp_dir}/wh2", *common])["rows"] == 2
    out = main(["run", "--input", f"{tmp_dir}/in.csv", "--schema", DDL, "--workdir", f"{tmp_dir}/e2e", *common])
    assert (out["extracted"], out["processed"], out["loaded"], out["summary_rows"]) == (4, 2, 2, 2)
