"""Types found in the data: of CSV columns from all their values, of Parquet datasets from their shapes.

Types form a lattice: each has those above it that hold all of its values
(int - bigint - double - string, date - timestamp - string, boolean - string).
A column's type is the lowest one that all its values fit.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.columns import quoted
from sluice.sources.files import read_csv, read_parquet

# The types of the lattice below string, the lowest first.
LATTICE = ("boolean", "int", "bigint", "double", "date", "timestamp_ntz")
_DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def fits(c: Column, kind: str) -> Column:
    """Whether a text is a value of the type, in the forms that the CSV reader takes for it; never NULL."""
    digits = c.rlike("^[+-]?[0-9]{1,38}$")
    tests = {
        "boolean": F.lower(c).isin("true", "false"),
        "int": digits & c.try_cast("int").isNotNull(),
        "bigint": digits & c.try_cast("bigint").isNotNull(),
        "double": c.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
        "date": c.rlike(f"^{_DATE}$") & c.try_cast("date").isNotNull(),
        "timestamp_ntz": c.rlike(f"^{_DATE}([ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?)?$") & c.try_cast("timestamp_ntz").isNotNull(),
    }
    return F.coalesce(tests[kind], F.lit(False))


def column_types(texts: DataFrame, most_conflicts: int = 0) -> DataFrame:
    """(column_name, type, values, nulls, not_<type>...) of each column of ``texts``, all strings; one aggregate over all rows.

    ``not_<type>`` counts the values that aren't of the type: with a column that should be a date, how many
    aren't.  The type is the lowest that all values fit but ``most_conflicts``; a column without values is a string.
    """
    counts = []
    for name in texts.columns:
        c = quoted(name)
        each = [F.count_if(c.isNotNull() & ~fits(c, k)).alias(f"not_{k}") for k in LATTICE]
        counts.append(F.struct(F.lit(name).alias("column_name"), F.count(c).alias("values"), F.count_if(c.isNull()).alias("nulls"), *each))
    rows = texts.agg(F.array(*counts).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")
    kind = F.when(F.col("values") == 0, "string")
    for k in LATTICE:
        kind = kind.when(F.col(f"not_{k}") <= most_conflicts, k)
    return rows.select("column_name", kind.otherwise("string").alias("type"), "values", "nulls", *(f"not_{k}" for k in LATTICE))


def infer_types(spark: SparkSession, path: str | Sequence[str], most_conflicts: int = 0, **options: str) -> DataFrame:
    """``column_types`` of CSV files with a header; all values of all rows count, none is sampled."""
    return column_types(read_csv(spark, path, infer_schema=False, **options), most_conflicts)


def read_csv_typed(spark: SparkSession, path: str | Sequence[str], most_conflicts: int = 0, **options: str) -> DataFrame:
    """CSV files in the types that their values have; with ``most_conflicts`` values that don't fit become NULL."""
    texts = read_csv(spark, path, infer_schema=False, **options)
    kinds = {r["column_name"]: r["type"] for r in column_types(texts, most_conflicts).collect()}  # one row a column
    typed = [F.when(fits(quoted(c), k), quoted(c).try_cast(k)).alias(c) if (k := kinds[c]) != "string" else quoted(c) for c in texts.columns]
    return texts.select(*typed)


_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def least_upper_bound(a: T.DataType, b: T.DataType) -> T.DataType:
    """The lowest type that holds the values of both; string, if nothing lower does."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if type(a) in _WIDTH and type(b) in _WIDTH:
        return a if _WIDTH[type(a)] > _WIDTH[type(b)] else b
    exact = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    as_decimal = [T.DecimalType(exact[type(x)], 0) if type(x) in exact else x for x in (a, b)]
    if all(isinstance(x, T.DecimalType) for x in as_decimal):
        scale = max(x.scale for x in as_decimal)
        whole = max(x.precision - x.scale for x in as_decimal)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if all(isinstance(x, T.NumericType) for x in (a, b)):
        return T.DoubleType()
    times = (T.DateType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    if all(isinstance(x, (T.DateType, T.TimestampType)) for x in (a, b)):
        return T.TimestampType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(least_upper_bound(a.elementType, b.elementType), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return reconciled_schema([a, b])
    return T.StringType()


def reconciled_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of the schemas, in the order in which they first come, each in a type that holds its values everywhere."""
    found: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            found[f.name] = least_upper_bound(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(n, t, True) for n, t in found.items()])


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: cast where the type is another, NULL where there is none."""
    return df.select(*[(quoted(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_reconciled(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet datasets of different shapes as one table: one scan for each shape, cast to the least schema that holds all.

    Footers of one file a dataset are read for its shape; datasets of one shape share a scan.
    """
    shapes: dict[str, list[str]] = {}
    for path in paths:
        shapes.setdefault(read_parquet(spark, path).schema.json(), []).append(path)
    if not shapes:
        raise ValueError("no datasets to read")
    known = {shape: T.StructType.fromJson(json.loads(shape)) for shape in shapes}
    target = schema or reconciled_schema(list(known.values()))
    return reduce(DataFrame.unionByName, [as_schema(read_parquet(spark, group, schema=known[shape]), target) for shape, group in shapes.items()])
