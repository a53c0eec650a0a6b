"""Command line for the daily steps (usable with ``spark-submit``).

    python -m sluice extract   --input data.csv --schema "id int, ..." --raw /lake/raw
    python -m sluice transform --raw /lake/raw --processed /lake/processed
    python -m sluice load      --processed /lake/processed --target /lake/warehouse/processed_data
    python -m sluice summary   --table /lake/warehouse/processed_data --out /lake/warehouse/daily_summary
    python -m sluice report    --input /lake/raw/extracted_data_20240115_000000
    python -m sluice run       --input data.csv --schema "..." --workdir /lake

``load`` and ``summary`` take ``--jdbc-url``/``--table`` to use a relational
target instead (credentials from ``POSTGRES_*`` variables).  Every step prints
one JSON line with its row counts.
"""

from __future__ import annotations

import argparse
import json
import sys

from sluice.operators.quality import quality_summary
from sluice.plans import flows
from sluice.session import build_session
from sluice.sources.files import glob_exists, read_csv, read_parquet
from sluice.sources.jdbc import jdbc_config_from_env


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="step", required=True)

    def common(sp):
        sp.add_argument("--as-of", help="fixed timestamp for lineage columns (reproducible runs)")
        sp.add_argument("--run-id", help="run id (default: now, %%Y%%m%%d_%%H%%M%%S)")
        return sp

    e = common(sub.add_parser("extract", help="land a CSV source as Parquet with lineage columns"))
    e.add_argument("--input", required=True)
    e.add_argument("--schema", help="DDL schema of the CSV (inferred when omitted)")
    e.add_argument("--raw", required=True)
    e.add_argument("--source-system", default="csv")
    e.add_argument("--export", help="folder for a CSV copy of the landed data")

    t = common(sub.add_parser("transform", help="report, clean and enrich every landed dataset"))
    t.add_argument("--raw", required=True)
    t.add_argument("--processed", required=True)
    t.add_argument("--csv-schema", help="DDL schema for landed CSV files (inferred when omitted)")
    t.add_argument("--export", help="folder for CSV copies of CSV-sourced outputs")
    t.add_argument("--batched", action="store_true",
                   help="all landed Parquet datasets in one pass (output partitioned by dataset)")

    ld = common(sub.add_parser("load", help="conform and load processed data"))
    ld.add_argument("--processed", required=True)
    ld.add_argument("--target", help="partitioned Parquet table path")
    ld.add_argument("--jdbc-url")
    ld.add_argument("--table", default="processed_data")
    ld.add_argument("--audit", help="audit-trail folder (guards JDBC re-runs)")

    s = common(sub.add_parser("summary", help="daily summary of the loaded table"))
    s.add_argument("--table", required=True, help="table path, or table name with --jdbc-url")
    s.add_argument("--out", default="daily_summary", help="output path, or table name with --jdbc-url")
    s.add_argument("--jdbc-url")

    r = sub.add_parser("report", help="print the quality report of a dataset")
    r.add_argument("--input", required=True)
    r.add_argument("--format", choices=("parquet", "csv"), default="parquet")

    run = common(sub.add_parser("run", help="extract -> validate -> transform -> load -> verify -> summary"))
    run.add_argument("--input", required=True)
    run.add_argument("--schema")
    run.add_argument("--workdir", required=True)
    run.add_argument("--source-system", default="csv")
    run.add_argument("--batched", action="store_true", help="transform all landed datasets in one pass")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(f"sluice-{args.step}")
    as_of = getattr(args, "as_of", None)
    rid = getattr(args, "run_id", None)
    if args.step == "extract":
        res = flows.extract(spark, args.input, args.raw, args.source_system, rid=rid, schema=args.schema,
                            as_of=as_of, export_root=args.export)
        out = {"rows": res.rows, "path": res.path, **res.details}
    elif args.step == "transform":
        if args.batched:
            res = flows.transform_batched(spark, args.raw, args.processed, as_of=as_of)
        else:
            res = flows.transform(spark, args.raw, args.processed, as_of=as_of, csv_schema=args.csv_schema,
                                  export_root=args.export)
        out = {"rows": res.rows, "datasets": sorted(res.details["reports"])}
    elif args.step == "load":
        root = args.processed.rstrip("/")
        # per-dataset folders (transform) or dataset partitions (transform --batched)
        paths = [p for p in (f"{root}/{flows.PROCESSED_PREFIX}*", f"{root}/{flows.DATASET_COLUMN}=*")
                 if glob_exists(spark, p)]
        if args.jdbc_url:
            cfg = jdbc_config_from_env()
            src = read_parquet(spark, paths)
            res = flows.load_jdbc(src, args.jdbc_url, args.table, cfg["properties"], as_of=as_of,
                                  rid=rid, audit_path=args.audit)
            out = {"rows": res.rows, "table": args.table, **res.details}
        else:
            res = flows.load(spark, paths, args.target, as_of=as_of, rid=rid)
            out = {"rows": res.rows, "path": res.path}
    elif args.step == "summary":
        if args.jdbc_url:
            cfg = jdbc_config_from_env()
            res = flows.summarize_jdbc(spark, args.jdbc_url, args.table, args.out, cfg["properties"], as_of=as_of)
        else:
            res = flows.summarize(spark, args.table, args.out, as_of=as_of)
        out = {"rows": res.rows, "target": res.path}
    elif args.step == "report":
        df = read_parquet(spark, args.input) if args.format == "parquet" else read_csv(spark, args.input)
        out = quality_summary(df, args.input)
    else:
        src = read_csv(spark, args.input, schema=args.schema)
        res = flows.end_to_end(spark, src, args.workdir, args.source_system, as_of=as_of, rid=rid,
                               batched=args.batched)
        out = {k: v for k, v in res.items() if k != "reports"}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
