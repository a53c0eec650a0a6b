"""Run the driver contract in a session this library did not configure:
plain builder, another session time zone, module loaded by file path from
another directory.  Usage: ``python tests/foreign_session_check.py [sf_dir]``."""

from __future__ import annotations

import importlib.util
import os
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    os.chdir("/tmp")
    spec = importlib.util.spec_from_file_location("__spark_entry__", os.path.join(HERE, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "America/Los_Angeles")
             .getOrCreate())
    df = mod.entry(spark)
    print("entry", df.count(), df.columns)
    sys.path.insert(0, HERE)
    from tests.oracle_check import digest, duck

    bad = []
    for name, fn in mod.queries().items():
        out = fn(spark, sf_dir)
        rows = [tuple(r) for r in out.collect()]
        sql = mod.oracle_sql().get(name)
        if sql:
            cols, orows = duck(sf_dir, sql)
            if len(rows) != len(orows) or digest(out.columns, rows)[0] != digest(cols, orows)[0]:
                bad.append(name)
    print("checked", len(mod.queries()), "bad", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
