"""Types found in the data, and tables of different shapes read as one."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sinks.files import write_parquet
from sluice.sources import infer as I

VALUES = ["1", "-7", "+3", "007", "2147483647", "2147483648", "9223372036854775808", "1.5", "-.5", "2.", "1e5", ".", "", " 1", "1 ", "abc",
          "true", "FALSE", "yes", "2024-02-29", "2023-02-29", "2024-13-01", "2024-02-29 10:11:12", "2024-02-29T10:11:12.5", "2024-02-29 25:00:00", "é", None]


def slow_fits(v: str, kind: str) -> bool:
    body = v[1:] if v[:1] in ("+", "-") else v
    whole = body.isascii() and body.isdigit() and len(body) <= 38
    if kind == "boolean":
        return v.lower() in ("true", "false")
    if kind in ("int", "bigint"):
        bits = 31 if kind == "int" else 63
        return whole and -(2 ** bits) <= int(v) < 2 ** bits
    if kind == "double":
        try:
            float(v)
        except ValueError:
            return False
        return v.isascii() and v == v.strip() and "_" not in v and not any(c in v.lower() for c in ("nan", "inf"))
    formats = ["%Y-%m-%d"] if kind == "date" else ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f"]
    for f in formats:
        try:
            dt.datetime.strptime(v, f)
            return True
        except ValueError:
            pass
    return False


def test_each_value_fits_what_it_should(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string")
    got = df.select("i", *[I.fits(F.col("v"), k).alias(k) for k in I.LATTICE]).collect()
    for r in got:
        v = VALUES[r["i"]]
        assert {k: r[k] for k in I.LATTICE} == {k: v is not None and slow_fits(v, k) for k in I.LATTICE}, v


def test_types_and_conflicts_of_columns(spark, tmp_dir):
    columns = {"a b": ["1", "2", None, "3"], "c.d": ["1", "2147483648", "x", "4"], "e": ["1", "0.5", "2", "3"], "f": [None] * 4,
               "g": ["2024-01-01", "2024-01-02 03:04:05", None, "2024-01-01"], "h": ["true", "false", "1", "TRUE"]}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    got = {r["column_name"]: r for r in I.column_types(df).collect()}
    assert {c: r["type"] for c, r in got.items()} == {"a b": "int", "c.d": "string", "e": "double", "f": "string", "g": "timestamp_ntz", "h": "string"}
    for c, vs in columns.items():
        known = [v for v in vs if v is not None]
        assert (got[c]["values"], got[c]["nulls"]) == (len(known), len(vs) - len(known))
        assert all(got[c][f"not_{k}"] == sum(not slow_fits(v, k) for v in known) for k in I.LATTICE)
    df.write.option("header", "true").csv(f"{tmp_dir}/in.csv")
    strict, lax = I.read_csv_typed(spark, f"{tmp_dir}/in.csv"), I.read_csv_typed(spark, f"{tmp_dir}/in.csv", most_conflicts=1)
    assert dict(strict.dtypes) == {"a b": "int", "c.d": "string", "e": "double", "f": "string", "g": "timestamp_ntz", "h": "string"}
    assert dict(lax.dtypes) == {"a b": "int", "c.d": "bigint", "e": "int", "f": "string", "g": "date", "h": "boolean"}
    assert sorted((r["c.d"] for r in lax.collect()), key=repr) == [1, 2147483648, 4, None]
    empty = I.column_types(df.limit(0)).collect()
    assert [r["type"] for r in empty] == ["string"] * 6


ATOMS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 0),
         T.DecimalType(38, 18), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.StringType(), T.BooleanType(), T.NullType(), T.BinaryType()]
KINDS = st.recursive(st.sampled_from(ATOMS), lambda inner: st.one_of(inner.map(T.ArrayType), st.lists(st.tuples(st.sampled_from("xyz"), inner), min_size=1, max_size=3, unique_by=lambda f: f[0]).map(
    lambda fs: T.StructType([T.StructField(n, t) for n, t in fs]))), max_leaves=4)


@settings(max_examples=300, deadline=None)
@given(KINDS, KINDS, KINDS)
def test_the_lattice_is_one(a, b, c):
    lub = I.least_upper_bound
    assert lub(a, a) == a
    names = lambda t: t.simpleString() if not isinstance(t, T.StructType) else sorted((f.name, f.dataType.simpleString()) for f in t.fields)
    assert names(lub(a, b)) == names(lub(b, a)) or isinstance(a, (T.ArrayType, T.StructType))
    assert lub(lub(a, b), b) == lub(a, b)
    if not any(isinstance(x, (T.DecimalType, T.FloatType, T.TimestampType, T.TimestampNTZType, T.ArrayType, T.StructType)) for x in (a, b, c)):
        assert lub(lub(a, b), c) == lub(a, lub(b, c)) or T.StringType() in (lub(lub(a, b), c), lub(a, lub(b, c)))


def test_three_shapes_are_read_as_one(spark, tmp_dir):
    shapes = {
        "a": ("id int, name string, price decimal(10,2)", [(1, "x", decimal.Decimal("1.25")), (None, None, None)]),
        "b": ("price bigint, id bigint", [(2 ** 40, 2 ** 40), (None, 5)]),
        "c": ("more date, id int, name int", [(dt.date(2024, 1, 1), 9, 77)]),
        "again": ("id int, name string, price decimal(10,2)", [(1, "x", decimal.Decimal("1.25"))]),
        "empty": ("id smallint, more timestamp_ntz", []),
    }
    for n, (schema, data) in shapes.items():
        write_parquet(spark.createDataFrame(data, schema), f"{tmp_dir}/{n}")
    got = I.read_reconciled(spark, [f"{tmp_dir}/{n}" for n in shapes])
    assert dict(got.dtypes) == {"id": "bigint", "name": "string", "price": "decimal(22,2)", "more": "timestamp_ntz"}
    want = [(1, "x", decimal.Decimal("1.25"), None)] * 2 + [(None,) * 4, (2 ** 40, None, decimal.Decimal(2 ** 40), None), (5, None, None, None), (9, "77", None, dt.datetime(2024, 1, 1))]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 4  # equal shapes share a scan
    with pytest.raises(ValueError):
        I.read_reconciled(spark, [])
