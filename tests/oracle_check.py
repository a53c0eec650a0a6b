"""Run every registered query in Spark and its SQL twin in DuckDB on the same
parquet tables; compare row count, column names and an order-insensitive
value hash.  Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from sluice.session import build_session

    spark = build_session("oracle-check", master="local[8]", shuffle_partitions=8)
    qs, oracle = entry.queries(), entry.oracle_sql()
    results = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as err:  # report and continue
            results[name] = f"SPARK ERROR {type(err).__name__}: {str(err)[:300]}"
            print(name, results[name], flush=True)
            continue
        secs = time.time() - t0
        if name not in oracle:
            results[name] = f"rows-only {len(rows)}"
            print(f"{name:28s} rows-only rows={len(rows)} {secs:.1f}s", flush=True)
            continue
        try:
            ocols, orows = duck(sf_dir, oracle[name])
        except Exception as err:
            results[name] = f"DUCK ERROR {err}"
            print(name, results[name], flush=True)
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        results[name] = "OK" if ok else "MISMATCH"
        print(f"{name:28s} {'OK' if ok else 'MISMATCH'} rows={len(rows)}/{len(orows)} {secs:.1f}s", flush=True)
        if not ok:
            if sorted(cols) != sorted(ocols):
                print("   cols", sorted(cols), sorted(ocols))
            a, b = set(l1), set(l2)
            print("   spark-only", list(a - b)[:3])
            print("   duck-only ", list(b - a)[:3])
    bad = [k for k, v in results.items() if v not in ("OK",) and not v.startswith("rows-only")]
    print(json.dumps({"total": len(results), "bad": bad}))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
