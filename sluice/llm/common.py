"""Helpers that several operators share: Arrow row maps, stored intermediates, ordered ranks, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.session import scratch_dir

#: Result rows that a task gathers before it hands them on.
CHUNK = 8192



def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as Spark ships Python files; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="sluice-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_rows(df: DataFrame, columns: list[str], make: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """Apply ``make(*python lists of the columns) -> iterator of output tuples`` to each Arrow batch.

    Only the named columns leave the scan; extra columns of any name are not
    read.  Batches are bounded by Spark's Arrow settings and results leave in
    chunks, so memory is bounded too.
    """
    ship(df.sparkSession)
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(*(batch.column(i).to_pylist() for i in range(len(columns))))
            while rows := list(islice(made, CHUNK)):
                cells = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cells, arrow, strict=True)], schema=arrow)

    return df.select(*(F.col(f"`{c}`") for c in columns)).mapInArrow(run, schema)


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(_struct(ddl))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage at a copy that all executors can read, so that a lost
    executor costs its running tasks only.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_rank(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the row's place (from 0) within its key, by ``order``; nulls come first.

    Rows are range-partitioned by keys and order, so that a key with a third
    of all rows spreads over many tasks.  Each partition counts its own rows
    of a key in one pass.  Only a partition's first key can have begun in an
    earlier one; what it has there is added, from one row a partition that
    comes to the driver.
    """
    ship(df.sparkSession)
    cols = [F.col(c).asc_nulls_first() for c in (*keys, *order)]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    at = [df.columns.index(k) for k in keys]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, run, local, last = context.partitionId() if context else 0, 0, 0, None
        for batch in batches:
            runs, locals_ = [], []
            for key in zip(*(batch.column(i).to_pylist() for i in at), strict=True):
                if last is not None and key != last:
                    run, local = run + 1, 0
                runs.append(run)
                locals_.append(local)
                local, last = local + 1, key
            extra = [pa.array([part] * len(runs), pa.int32()), pa.array(runs, pa.int64()), pa.array(locals_, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "__part", "__run", "__local"])

    schema = StructType([*df.schema.fields, *_struct("__part int, __run bigint, __local bigint").fields])
    counted = stored(ranged.mapInArrow(count, schema), "rank")
    key = F.struct(*keys)
    edges = counted.groupBy("__part").agg(
        F.min_by(key, "__run").alias("first"), F.max_by(key, "__run").alias("last"), F.max(F.struct("__run", "__local")).alias("end"))
    before: dict[int, int] = {}
    last, upto = None, 0
    for e in sorted(edges.collect(), key=lambda e: e["__part"]):
        begun = upto if e["first"] == last else 0
        if begun:
            before[e["__part"]] = begun
        upto = e["end"]["__local"] + 1 + (begun if e["end"]["__run"] == 0 else 0)
        last = e["last"]
    more = F.lit(0)
    if before:
        begun = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
        more = F.when(F.col("__run") == 0, F.coalesce(F.try_element_at(begun, F.col("__part")), F.lit(0))).otherwise(0)
    return counted.withColumn(name, F.col("__local") + more).drop("__part", "__run", "__local")


def components(edges: DataFrame, low: str = "a", high: str = "b", every: int = 4) -> DataFrame:
    """Connected components of the undirected ``edges``: (node, component), component the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014), which
    end with every node linked to its component's smallest one.  Each step
    regroups by node through a minimum with partial aggregation and a join, so
    neighbourhoods are never gathered in one task; the edges are written to
    the shared folder after each round.  Empty edges give no rows.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(low, high).alias("u"), F.least(low, high).alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, "components")
    before = None
    while True:
        # large-star: larger neighbours of u move to the smallest node of u's closed neighbourhood
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low_of = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low_of, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small-star: u and its smaller neighbours move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        pairs = stored(small, "components")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def held_out(key: str = "doc_id", fold: int = 1, folds: int = 3) -> Column:
    """Whether a row belongs to the fold kept out of fitting: crc32 of its key as text (null: empty), modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def bounded_sample(df: DataFrame, by: str, key: str, most: int) -> DataFrame:
    """About ``most`` rows at most of each value of ``by``, chosen by a hash of ``key``: the same rows each time."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    share = F.pmod(F.xxhash64(key), F.lit(1 << 20)) < F.least(F.lit(1.0), most / F.col("__n")) * (1 << 20)
    return df.join(F.broadcast(sizes), by).where(share).drop("__n")
