"""What is known of rows seen before: Bloom filters and distinct-count sketches that merge.

Both are small aggregates of a part of a table (a run, a dataset), kept beside
it and merged on read, so that a question about the whole table doesn't read
its rows again.

A Bloom filter is kept as its 64-bit words that aren't zero.  Filters of parts
merge by ``bit_or``; words collapse in the partial aggregate.  A merged filter
is one array of ``bits / 64`` longs, whatever was put in: 2 MB by default.  A
filter of more rows than it is made for lets more rows through, and the exact
comparison behind it does more; results don't change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from sluice.functions.columns import quoted
from sluice.session import scratch_dir
from sluice.sinks.files import write_parquet

#: Bits of a filter; at 2 ** 24, about one in a hundred of other rows passes one that holds 1.6 million.
BITS = 1 << 24
#: Bits set for a row.
HASHES = 4


def _positions(columns: Sequence[str], bits: int) -> list[Column]:
    """The bits of a row: an arithmetic sequence given by two hashes of it."""
    cols = [quoted(c) for c in columns]
    first, step = F.pmod(F.xxhash64(*cols), F.lit(bits)), F.pmod(F.xxhash64(F.lit("step"), *cols), F.lit(bits // 2)) * 2 + 1
    return [F.pmod(first + i * step, F.lit(bits)) for i in range(HASHES)]


def filter_words(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """(by..., word, mask): the Bloom filter of the rows' ``columns``, one for each value of ``by``."""
    at = df.select(*[quoted(k) for k in by], F.explode(F.array(*_positions(columns, bits))).alias("__at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("__at") % 64).cast("int"))
    return at.groupBy(*[quoted(k) for k in by], F.floor(F.col("__at") / 64).alias("word")).agg(F.bit_or(bit).alias("mask"))


def merge_words(words: DataFrame) -> DataFrame:
    """(word, mask) of all filters together."""
    return words.groupBy("word").agg(F.bit_or("mask").alias("mask"))


def may_hold(words: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Whether a row may be among those of the filter ``words``; never false for one that is.

    The filter is a scalar subquery: a value of fixed size that each task gets, as a literal would be.
    """
    whole = words.sparkSession.range(bits // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    entry = F.struct("word", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    masks = whole.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["mask"])).scalar()
    found = None
    for at in _positions(columns, bits):
        bit = F.getbit(F.get(masks, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1
        found = bit if found is None else found & bit
    return found


def drop_seen(rows: DataFrame, seen: DataFrame, words: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """``rows`` without those whose ``columns`` occur in ``seen`` (NULL equals NULL); ``words`` is a filter of ``seen``.

    Each row is looked up once, and written with the answer to the shared scratch folder.  Rows that the filter has
    never seen go on as they are.  The others are compared: with the rows of ``seen`` that a filter of these others
    lets through, so that neither side moves whole.  Rows that are copies of each other stay.
    """
    marked = scratch_dir(rows.sparkSession, "seen")
    write_parquet(rows.withColumn("__held", may_hold(words, columns, bits)), marked)
    looked_up = rows.sparkSession.read.schema(StructType([*rows.schema.fields, StructField("__held", BooleanType())])).parquet(marked)
    maybe, fresh = (looked_up.where(F.col("__held") == held).drop("__held") for held in (True, False))
    known = seen.where(may_hold(filter_words(maybe, columns, bits=bits), columns, bits))
    known = known.select(*[quoted(c).alias(f"__{c}") for c in columns])
    same = [quoted(c).eqNullSafe(quoted(f"__{c}")) for c in columns]
    return fresh.unionByName(maybe.join(known, same, "left_anti"))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """(by..., sketch): an HLL sketch of the distinct rows of each value of ``by``; its standard error is 1.04 / 2 ** (lg_k / 2)."""
    row = F.xxhash64(*[quoted(c) for c in columns])
    return df.groupBy(*[quoted(k) for k in by]).agg(F.hll_sketch_agg(row, lg_k).alias("sketch"))


def distinct_of_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., distinct_rows): the estimate for each value of ``by``, and of their union in a row with NULL there."""
    each = sketches.select(*[quoted(k) for k in by], F.hll_sketch_estimate("sketch").alias("distinct_rows"))
    none = [F.lit(None).cast(sketches.schema[k].dataType).alias(k) for k in by]
    whole = sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_rows"))
    return each.unionByName(whole.select(*none, "distinct_rows")) if by else whole
