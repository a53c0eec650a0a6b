"""Registered queries: one per operator row of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the driver's tables in full and
returns a DataFrame.  Builders that exercise a sink write to a fresh folder
below the session's checkpoint directory and return the read-back data.
``ORACLE_SQL`` holds an independent DuckDB statement per builder where the
result is SQL-expressible (same column names; timestamps fixed by ``AS_OF``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import clean as C
from sluice.operators import enrich as E
from sluice.operators import modeling as M
from sluice.operators import quality as Q
from sluice.operators.conform import conform_to_schema
from sluice.operators.impute import impute
from sluice.operators.summarize import daily_summary
from sluice.plans import flows
from sluice.schemas import DAILY_SUMMARY_SCHEMA, PROCESSED_SCHEMA
from sluice.session import scratch_dir
from sluice.streaming.incremental import incremental_transform, read_increments
from sluice.sinks.files import write_csv, write_parquet, write_partitioned
from sluice.sinks.snapshots import SnapshotTable, compact, file_sizes
from sluice.sources import changes
from sluice.sources.derived import churn_frame, dirty_records, events_as_records, table
from sluice.sources.infer import infer_types, read_reconciled
from sluice.sources.files import (
    CSV_TIMESTAMP_FORMAT, CSV_TIMESTAMP_FORMAT_MICROS, read_csv, read_parquet, with_source_file,
)

# Fixed clock for every lineage stamp of the registered queries.
AS_OF = "2024-02-01 00:00:00"

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- inputs

def records(spark, d):
    return events_as_records(table(spark, d, "events"))


def dirty(spark, d):
    return dirty_records(table(spark, d, "events"))


def churn(spark, d):
    return churn_frame(table(spark, d, "customer"), table(spark, d, "orders"),
                       table(spark, d, "nation"), table(spark, d, "region"))


def cleaned(spark, d):
    return C.clean_records(dirty(spark, d))


def enriched(spark, d, with_hash=False):
    return E.enrich_records(cleaned(spark, d), as_of=AS_OF, with_hash=with_hash)


SQL_RECORDS = 'select event_id as id, event_type as name, value, ts as "timestamp" from events'
SQL_DIRTY = """
select case when event_id % 101 = 0 then null when event_id % 19 = 0 then -event_id else event_id end as id,
       case when event_id % 101 = 0 or event_id % 7 = 0 then null
            when event_id % 3 = 0 then concat('  ', upper(event_type), ' ')
            else event_type end as name,
       case when event_id % 101 = 0 or event_id % 13 = 0 then null
            when event_id % 17 = 0 then 'nan'::double
            when event_id % 11 = 0 then -value else value end as value,
       case when event_id % 101 = 0 or event_id % 23 = 0 then null
            else ts + to_months(cast(event_id % 4 as integer)) end as "timestamp"
from (select *, unnest(case when event_id % 50 = 0 then [1, 2] else [1] end) as copy from events) e
"""


def sql_clean(src: str) -> str:
    return f"""
select distinct id, trim(lower(name)) as name, value, "timestamp"
from ({src}) s
where not (id is null and name is null and value is null and "timestamp" is null)
  and value > 0 and not isnan(value)
"""


def sql_enrich(src: str) -> str:
    return f"""
select *, timestamp '{AS_OF}' as processed_timestamp, '1.0' as processing_version,
       cast(year("timestamp") as int) as year, cast(month("timestamp") as int) as month,
       cast(day("timestamp") as int) as day,
       case when value < 100 then 'low' when value < 200 then 'medium' else 'high' end as value_category
from ({src}) s
"""


def sql_summary(src: str, with_ts: bool = True, scale: int = 2) -> str:
    ts = f", timestamp '{AS_OF}' as summary_timestamp" if with_ts else ""
    return f"""
select year, month, day, value_category,
       cast(count(*) as bigint) as record_count,
       cast(sum(cast(value as decimal(18,{scale}))) as double) / count(value) as avg_value,
       cast(min(value) as double) as min_value, cast(max(value) as double) as max_value{ts}
from ({src}) s
group by year, month, day, value_category
"""


SQL_CLEAN = sql_clean(SQL_DIRTY)
SQL_ENRICH = sql_enrich(SQL_CLEAN)

SQL_CHURN = """
select c.CustomerID,
       case when p.first_order is null then 0
            else cast(date_diff('day', p.first_order, p.last_order) // 30 + 1 as int) end as Tenure,
       p.TotalCharges / (case when p.first_order is null then 0
            else cast(date_diff('day', p.first_order, p.last_order) // 30 + 1 as int) end) as MonthlyCharges,
       p.TotalCharges, c.ContractType, c.Nation, c.Region,
       case when p.UrgentService = 1 then 'Yes' else 'No' end as UrgentService,
       case when p.HighService = 1 then 'Yes' else 'No' end as HighService,
       case when p.MediumService = 1 then 'Yes' else 'No' end as MediumService,
       case when p.UnspecifiedService = 1 then 'Yes' else 'No' end as UnspecifiedService,
       case when p.LowService = 1 then 'Yes' else 'No' end as LowService,
       case when p.last_order is null
                 or date_diff('day', p.last_order, (select max(cast(o_orderdate as date)) from orders)) > 365
            then 'Yes' else 'No' end as Churn
from (select customer.c_custkey as CustomerID,
             case when customer.c_custkey % 29 = 0 then null
                  when customer.c_custkey % 31 = 0 then customer.c_mktsegment || '|' || customer.c_mktsegment
                  else customer.c_mktsegment end as ContractType,
             g.Nation, g.Region
      from customer left join (select n_nationkey, n_name as Nation, r_name as Region
                               from nation left join region on n_regionkey = r_regionkey) g
        on customer.c_nationkey = g.n_nationkey) c
left join (select o_custkey as CustomerID,
                  min(cast(o_orderdate as date)) as first_order,
                  max(cast(o_orderdate as date)) as last_order,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as TotalCharges,
                  max(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as UrgentService,
                  max(case when o_orderpriority = '2-HIGH' then 1 else 0 end) as HighService,
                  max(case when o_orderpriority = '3-MEDIUM' then 1 else 0 end) as MediumService,
                  max(case when o_orderpriority = '4-NOT SPECIFIED' then 1 else 0 end) as UnspecifiedService,
                  max(case when o_orderpriority = '5-LOW' then 1 else 0 end) as LowService
           from orders group by o_custkey) p
  on c.CustomerID = p.CustomerID
"""


def sql_key(*columns: str) -> str:
    """A natural key's hash: each part with its length, NULL apart from any text."""
    parts = [f"case when {c} is null then '-' else length(cast({c} as varchar)) || ':' || cast({c} as varchar) end" for c in columns]
    return f"sha256({' || '.join(parts)})"


SQL_TENURE_BAND = ("case when Tenure is null then null when Tenure < 12 then '0-1y' when Tenure < 24 then '1-2y' "
                   "when Tenure < 48 then '2-4y' else '4y+' end")


# ---------------------------------------------------------------- 2.1 scans

@register("scan_parquet", SQL_RECORDS)
def q_scan_parquet(spark, d):
    return records(spark, d)


@register("scan_csv", "select * from events")
def q_scan_csv(spark, d):
    events = table(spark, d, "events")
    path = scratch_dir(spark, "scan_csv") + "/events.csv"
    write_csv(events, path, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    return read_csv(spark, path, schema=events.schema, timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)


@register("scan_csv_tsformat", """
select event_id as id, event_type as name, value, date_trunc('second', ts) as "timestamp" from events
""")
def q_scan_csv_tsformat(spark, d):
    recs = records(spark, d)
    path = scratch_dir(spark, "scan_csv_ts") + "/records.csv"
    write_csv(recs, path, timestamp_format=CSV_TIMESTAMP_FORMAT)
    return read_csv(spark, path, schema=recs.schema, timestamp_format=CSV_TIMESTAMP_FORMAT)


# One column of each kind of text, some with values that don't fit the others.
FAULTY_TEXTS = {
    "whole": ("cast(event_id as string)", "cast(event_id as varchar)"),
    "big": ("cast(event_id * 4000000007 as string)", "cast(event_id * 4000000007 as varchar)"),
    "fraction": ("case when event_id % 7 = 0 then null when event_id % 5 = 0 then '.5e-3' else concat('-', cast(event_id as string), '.25') end",
                 "case when event_id % 7 = 0 then null when event_id % 5 = 0 then '.5e-3' else concat('-', cast(event_id as varchar), '.25') end"),
    "moment": ("case when event_id % 3 = 0 then '2024-02-29' else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end",
               "case when event_id % 3 = 0 then '2024-02-29' else strftime(ts, '%Y-%m-%d %H:%M:%S') end"),
    "day": ("date_format(ts, 'yyyy-MM-dd')", "strftime(ts, '%Y-%m-%d')"),
    "flag": ("case when event_id % 2 = 0 then 'True' else 'false' end", "case when event_id % 2 = 0 then 'True' else 'false' end"),
    "faulty": ("case when event_id % 100 = 0 then 'n/a' when event_id % 100 = 1 then '2023-02-30' else cast(event_id as string) end",
               "case when event_id % 100 = 0 then 'n/a' when event_id % 100 = 1 then '2023-02-30' else cast(event_id as varchar) end"),
    "nothing": ("cast(null as string)", "cast(null as varchar)"),
}


def _sql_types(column: str) -> str:
    digits = f"regexp_full_match({column}, '[+-]?[0-9]{{1,38}}')"
    tests = {
        "boolean": f"lower({column}) in ('true', 'false')",
        "int": f"{digits} and try_cast({column} as int) is not null", "bigint": f"{digits} and try_cast({column} as bigint) is not null",
        "double": f"regexp_full_match({column}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')",
        "date": f"regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and try_cast({column} as date) is not null",
        "timestamp_ntz": f"regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?)?') and try_cast({column} as timestamp) is not null",
    }
    counts = ", ".join(f"cast(count_if({column} is not null and not coalesce({t}, false)) as bigint) as not_{k}" for k, t in tests.items())
    choice = " ".join(f"when not_{k} = 0 then '{k}'" for k in tests)
    return (f"select '{column}' as column_name, case when \"values\" = 0 then 'string' {choice} else 'string' end as type, * "
            f"from (select cast(count({column}) as bigint) as \"values\", cast(count_if({column} is null) as bigint) as nulls, {counts} from t) x")


@register("scan_csv_inferred", "with t as (select " + ", ".join(f"{sql} as {c}" for c, (_, sql) in FAULTY_TEXTS.items()) + " from events)\n"
          + "\nunion all\n".join(_sql_types(c) for c in FAULTY_TEXTS))
def q_scan_csv_inferred(spark, d):
    # the types of a CSV export of texts, by one pass over all its rows
    path = scratch_dir(spark, "scan_inferred") + "/texts.csv"
    write_csv(table(spark, d, "events").selectExpr(*(f"{sql} as {c}" for c, (sql, _) in FAULTY_TEXTS.items())), path)
    return infer_types(spark, path)


@register("scan_parquet_reconciled", """
select event_id as id, cast(value as double) as value, ts as at, event_type as name, null as more, 'a' as shape from events where event_id % 3 = 0
union all select event_id, cast(event_id % 7 as double), cast(cast(ts as date) as timestamp), null, 'x', 'b' from events where event_id % 3 = 1
union all select event_id, null, ts, cast(event_id as varchar), null, 'c' from events where event_id % 3 = 2
""")
def q_scan_reconciled(spark, d):
    # three shapes of one table: other order, narrower types, missing and additional columns, a number where others have text
    base, events = scratch_dir(spark, "shapes"), table(spark, d, "events")
    shapes = {
        "a": ["cast(event_id as int) as id", "event_type as name", "value", "ts as at", "'a' as shape"],
        "b": ["to_date(ts) as at", "event_id as id", "cast(event_id % 7 as int) as value", "'x' as more", "'b' as shape"],
        "c": ["'c' as shape", "event_id as id", "event_id as name", "ts as at"],
    }
    for i, (shape, columns) in enumerate(shapes.items()):
        write_parquet(events.where(F.col("event_id") % 3 == i).selectExpr(*columns), f"{base}/{shape}")
    return read_reconciled(spark, [f"{base}/{shape}" for shape in shapes])


@register("scan_parquet_multi", """
select event_id as id, event_type as name, value, ts as "timestamp", strftime(ts, '%Y%m%d') as run_id from events
""")
def q_scan_parquet_multi(spark, d):
    recs = records(spark, d).withColumn("run_id", F.date_format("timestamp", "yyyyMMdd"))
    base = scratch_dir(spark, "runs")
    write_partitioned(recs, base, keys=("run_id",))
    return read_parquet(spark, f"{base}/run_id=*", schema=recs.schema, base_path=base)


# ---------------------------------------------------------------- 2.2 sinks

@register("sink_parquet", SQL_ENRICH)
def q_sink_parquet(spark, d):
    path = scratch_dir(spark, "sink_parquet")
    write_parquet(enriched(spark, d), path)
    return spark.read.parquet(path)


@register("sink_csv_single", sql_summary(SQL_ENRICH))
def q_sink_csv_single(spark, d):
    summary = daily_summary(enriched(spark, d), as_of=AS_OF, exact_scale=2)
    path = scratch_dir(spark, "sink_csv") + "/daily_summary.csv"
    write_csv(summary, path, single_file=True, timestamp_format=CSV_TIMESTAMP_FORMAT)
    return read_csv(spark, path, schema=DAILY_SUMMARY_SCHEMA, timestamp_format=CSV_TIMESTAMP_FORMAT)


@register("sink_partitioned", SQL_ENRICH)
def q_sink_partitioned(spark, d):
    path = scratch_dir(spark, "sink_partitioned")
    write_partitioned(enriched(spark, d), path, keys=("year", "month"))
    return spark.read.parquet(path)


@register("sink_partitioned_versions", f"""
with one as (select * from ({SQL_ENRICH}) a), two as (select * from ({sql_enrich(sql_clean(SQL_RECORDS))}) b)
select *, 1 as version from one
union all select *, 2 from two
union all select *, 2 from one where not exists (select 1 from two where two.year is not distinct from one.year and two.month is not distinct from one.month)
""")
def q_sink_partitioned_versions(spark, d):
    # the second commit replaces the months it holds; the first version stays readable
    months = SnapshotTable(spark, scratch_dir(spark, "sink_versions"), ("year", "month"))
    months.commit(months.stage(enriched(spark, d)))
    months.commit(months.stage(E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False)))
    return months.read(1).withColumn("version", F.lit(1)).unionByName(months.read(2).withColumn("version", F.lit(2)))


SQL_CONFORMED = f"""
select cast(id as bigint) as id, name, cast(value as double) as value, "timestamp",
       cast(null as timestamp) as extraction_timestamp, cast(null as varchar) as source_system,
       processed_timestamp, processing_version, year, month, day, value_category,
       cast(null as bigint) as name_hash, timestamp '{AS_OF}' as load_timestamp
from ({SQL_ENRICH}) s
"""


@register("conform_to_schema", SQL_CONFORMED)
def q_conform(spark, d):
    stamped = E.stamp_timestamps(enriched(spark, d), ["load_timestamp"], as_of=AS_OF)
    return conform_to_schema(stamped, PROCESSED_SCHEMA)


@register("agg_verify_count", f"""
select 'r1' as run_id, count(*)::bigint as verified from ({SQL_CLEAN}) a
union all select 'r2', count(*)::bigint from ({sql_clean(SQL_RECORDS)}) b
""")
def q_verify_count(spark, d):
    # counted in each run's files; the load of each run has been compared with what it reported
    return flows.loaded_counts(spark, two_runs(spark, d, "verify"))


@register("load_many", f"""
select cast(count(*) as bigint) as total_rows from (
  select * from ({SQL_ENRICH}) a union all select * from ({sql_enrich(sql_clean(SQL_RECORDS))}) b) u
""")
def q_load_many(spark, d):
    base = scratch_dir(spark, "load_many")
    write_parquet(enriched(spark, d), f"{base}/processed/transformed_dirty")
    write_parquet(E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False),
                  f"{base}/processed/transformed_events")
    result = flows.load(spark, [f"{base}/processed/transformed_*"], f"{base}/warehouse", as_of=AS_OF, rid="r1")
    flows.verify_load(spark, f"{base}/warehouse", result.rows, rid="r1")
    return Q.row_count(flows.read_table(spark, f"{base}/warehouse")).select(F.col("total_rows").cast("bigint"))


# ---------------------------------------------------------------- 2.3 projections / filters

@register("project_columns", "select c_custkey, c_name, c_mktsegment from customer")
def q_project(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")


@register("stamp_literal", f"select *, 'events_parquet' as source_system, '1.0' as processing_version from ({SQL_RECORDS}) s")
def q_stamp_literal(spark, d):
    return E.stamp_literals(records(spark, d), {"source_system": "events_parquet", "processing_version": "1.0"})


@register("stamp_timestamp", f"""
select *, timestamp '{AS_OF}' as extraction_timestamp, timestamp '{AS_OF}' as load_timestamp from ({SQL_RECORDS}) s
""")
def q_stamp_timestamp(spark, d):
    return E.stamp_timestamps(records(spark, d), ["extraction_timestamp", "load_timestamp"], as_of=AS_OF)


@register("filter_positive", "select * from customer where c_acctbal > 0 and not isnan(c_acctbal)")
def q_filter_positive(spark, d):
    return C.filter_positive(table(spark, d, "customer"), "c_acctbal")


@register("filter_not_null", f"select * from ({SQL_DIRTY}) s where name is not null")
def q_filter_not_null(spark, d):
    return C.filter_not_null(dirty(spark, d), ["name"])


@register("filter_null_or_nan", f"select * from ({SQL_DIRTY}) s where value is null or isnan(value)")
def q_filter_null_or_nan(spark, d):
    return C.filter_missing(dirty(spark, d), "value")


@register("sample_rows", f"select * from ({SQL_RECORDS}) s order by id limit 5")
def q_sample_rows(spark, d):
    return Q.sample_rows(records(spark, d), 5, order_by=["id"])


# ---------------------------------------------------------------- 2.4 scalar functions

@register("fn_lower_trim", f'select id, trim(lower(name)) as name, value, "timestamp" from ({SQL_DIRTY}) s')
def q_lower_trim(spark, d):
    return C.clean_strings(dirty(spark, d))


@register("fn_date_parts", f"""
select *, cast(year("timestamp") as int) as year, cast(month("timestamp") as int) as month,
       cast(day("timestamp") as int) as day from ({SQL_DIRTY}) s
""")
def q_date_parts(spark, d):
    return E.add_date_parts(dirty(spark, d))


@register("fn_case_bucket", f"""
select *, case when value < 100 then 'low' when value < 200 then 'medium' else 'high' end as value_category
from ({SQL_DIRTY}) s
""")
def q_case_bucket(spark, d):
    return E.add_band(dirty(spark, d))


UINT = "4294967295::ubigint"
# Murmur3 with seed 42 over the bytes of the name: words of four bytes, then single signed bytes.
SQL_MURMUR = f"""
with n as (select event_id as id, event_type as name, value, ts as "timestamp", hex(encode(event_type)) as hx,
                  octet_length(encode(event_type)) as len from events),
b as (select *, list_transform(range(0, len), lambda i: ((strpos('0123456789ABCDEF', substr(hx, 2 * i + 1, 1)) - 1) * 16
                  + strpos('0123456789ABCDEF', substr(hx, 2 * i + 2, 1)) - 1)::ubigint) as bs from n),
w as (select *, list_concat(
        list_transform(range(0, len // 4), lambda j: bs[4 * j + 1] + bs[4 * j + 2] * 256 + bs[4 * j + 3] * 65536 + bs[4 * j + 4] * 16777216),
        list_transform(range(len // 4 * 4, len), lambda i: case when bs[i + 1] > 127 then bs[i + 1] + 4294967040 else bs[i + 1] end)) as k0 from b),
k1 as (select *, list_transform(k0, lambda k: (k * 3432918353::ubigint) & {UINT}) as k1 from w),
k2 as (select *, list_transform(k1, lambda k: ((((k << 15) | (k >> 17)) & {UINT}) * 461845907::ubigint) & {UINT}) as k2 from k1),
h as (select *, xor(list_reduce(list_concat([42::ubigint], k2),
        lambda h, k: ((((xor(h, k) << 13) | (xor(h, k) >> 19)) & {UINT}) * 5 + 3864292196::ubigint) & {UINT}), len::ubigint) as h0 from k2),
f1 as (select *, (xor(h0, h0 >> 16) * 2246822507::ubigint) & {UINT} as h1 from h),
f2 as (select *, (xor(h1, h1 >> 13) * 3266489909::ubigint) & {UINT} as h2 from f1),
f3 as (select *, xor(h2, h2 >> 16)::bigint as h3 from f2)
select id, name, value, "timestamp", case when name is null then 42 when h3 > 2147483647 then h3 - 4294967296 else h3 end as name_hash from f3
"""


@register("fn_hash_murmur", SQL_MURMUR)
def q_hash_murmur(spark, d):
    return E.add_hash(records(spark, d))


# ---------------------------------------------------------------- 2.5 missing data / duplicates

@register("drop_all_null", f"""
select * from ({SQL_DIRTY}) s
where not (id is null and name is null and value is null and "timestamp" is null)
""")
def q_drop_all_null(spark, d):
    return C.drop_all_null(dirty(spark, d))


@register("fill_nulls", f"""
select id, coalesce(name, 'unknown') as name,
       case when value is null or isnan(value) then 0.0 else value end as value, "timestamp"
from ({SQL_DIRTY}) s
""")
def q_fill_nulls(spark, d):
    return C.fill_nulls(dirty(spark, d), {"value": 0.0, "name": "unknown"})


@register("dedup_rows", f"select distinct * from ({SQL_DIRTY}) s")
def q_dedup(spark, d):
    return C.dedup(dirty(spark, d))


@register("dedup_rows_stamped", f"""
select id, name, value, "timestamp", extraction_timestamp, source_system
from (select *, row_number() over (partition by id, name, value, "timestamp"
                                   order by extraction_timestamp nulls last, source_system nulls last) as place
      from (select *, timestamp '{AS_OF}' as extraction_timestamp, 'events' as source_system from ({SQL_DIRTY}) a
            union all select *, timestamp '2024-03-01 00:00:00', 'archive' from ({SQL_RECORDS}) b
            union all select *, timestamp '{AS_OF}', 'crm' from ({SQL_RECORDS}) c
            union all select *, null, 'aaa' from ({SQL_RECORDS}) e) s) t
where place = 1
""")
def q_dedup_stamped(spark, d):
    # copies of one row with four stamps: all stamps of the result come from one of them
    landed = [flows.stamp_extraction(dirty(spark, d), "events", AS_OF), flows.stamp_extraction(records(spark, d), "archive", "2024-03-01 00:00:00"),
              flows.stamp_extraction(records(spark, d), "crm", AS_OF),
              flows.stamp_extraction(records(spark, d), "aaa", AS_OF).withColumn("extraction_timestamp", F.lit(None).cast("timestamp_ntz"))]
    return C.dedup(reduce(DataFrame.unionByName, landed))


# ---------------------------------------------------------------- 2.6 aggregations

@register("agg_count", f"select cast(count(*) as bigint) as total_rows from ({SQL_DIRTY}) s")
def q_count(spark, d):
    return Q.row_count(dirty(spark, d))


@register("agg_null_counts", f"""
select cast(count_if(id is null) as bigint) as id, cast(count_if(name is null) as bigint) as name,
       cast(count_if(value is null) as bigint) as value, cast(count_if("timestamp" is null) as bigint) as "timestamp"
from ({SQL_DIRTY}) s
""")
def q_null_counts(spark, d):
    return Q.null_counts(dirty(spark, d))


def _sql_missing_row(col: str, cond: str) -> str:
    return (f"select '{col}' as column_name, cast(count_if({cond}) as bigint) as missing_count, "
            f"cast(count_if({cond}) as double) * 100.0::double / count(*) as missing_pct from d")


@register("agg_missing_profile", f"""
with d as ({SQL_DIRTY})
{_sql_missing_row('id', 'id is null')}
union all {_sql_missing_row('name', 'name is null')}
union all {_sql_missing_row('value', 'value is null or isnan(value)')}
union all {_sql_missing_row('timestamp', '"timestamp" is null')}
""")
def q_missing_profile(spark, d):
    return Q.missing_profile(dirty(spark, d))


@register("agg_group_count", f'select name, cast(count(*) as bigint) as "count" from ({SQL_DIRTY}) s group by name')
def q_group_count(spark, d):
    return Q.group_counts(dirty(spark, d), "name")


def _sql_describe_row(col: str, src: str) -> str:
    dec = f"cast({col} as decimal(12,2))"
    s = f"cast(sum({dec}) as double)"
    q = f"cast(sum({dec} * {dec}) as double)"
    n = f"cast(count({col}) as double)"
    return (f"select '{col}' as column_name, cast(count({col}) as bigint) as count, "
            f"cast(sum(cast({col} as decimal(18,2))) as double) / {n} as mean, "
            f"case when {n} > 1 then sqrt(({q} - {s} * {s} / {n}) / ({n} - 1)) end as stddev, "
            f"cast(min({col}) as double) as min, cast(max({col}) as double) as max from {src}")


LINEITEM_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("agg_describe", "\nunion all\n".join(_sql_describe_row(c, "lineitem") for c in LINEITEM_NUMERIC))
def q_describe(spark, d):
    return Q.describe(table(spark, d, "lineitem"), LINEITEM_NUMERIC, exact_scale=2)


SQL_DUP_PROFILE = f"""
with d as ({SQL_DIRTY}),
     t as (select cast(count(*) as bigint) as total_rows,
                  (select cast(count(*) as bigint) from (select distinct * from d) x) as distinct_rows from d)
select total_rows, distinct_rows, total_rows - distinct_rows as duplicate_rows,
       cast(total_rows - distinct_rows as double) * 100.0::double / total_rows as duplicate_pct from t
"""


@register("agg_distinct_count", SQL_DUP_PROFILE)
def q_distinct_count(spark, d):
    return Q.duplicate_profile(dirty(spark, d))


SQL_FLAGSHIP = sql_summary(sql_enrich(sql_clean(SQL_RECORDS)))


@register("agg_daily_summary", SQL_FLAGSHIP)
def q_daily_summary(spark, d):
    recs = C.clean_records(records(spark, d))
    return daily_summary(E.enrich_records(recs, as_of=AS_OF, with_hash=False), as_of=AS_OF, exact_scale=2)


SQL_FINE = """select l_orderkey as id, l_returnflag as name, l_extendedprice * l_discount as value,
       l_shipdate as "timestamp" from lineitem"""


def discounts(spark, d):
    # values of four decimals, over the years of the shipping dates
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("name"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("value"), F.col("l_shipdate").alias("timestamp"))


@register("agg_daily_summary_fine", sql_summary(sql_enrich(sql_clean(SQL_FINE)), scale=4))
def q_daily_summary_fine(spark, d):
    recs = C.clean_records(discounts(spark, d))
    return daily_summary(E.enrich_records(recs, as_of=AS_OF, with_hash=False), as_of=AS_OF, exact_scale=4)


# ---------------------------------------------------------------- 2.7 data quality

@register("dq_report", f"""
with d as ({SQL_DIRTY})
select cast(count(*) as bigint) as total_rows,
       (select cast(count(*) as bigint) from (select distinct * from d) x) as distinct_rows,
       cast(count(*) as bigint) - (select cast(count(*) as bigint) from (select distinct * from d) x) as duplicates,
       cast(count_if(id is null) as bigint) as missing_id,
       cast(count_if(name is null) as bigint) as missing_name,
       cast(count_if(value is null or isnan(value)) as bigint) as missing_value,
       cast(count_if("timestamp" is null) as bigint) as missing_timestamp
from d
""")
def q_dq_report(spark, d):
    return Q.quality_report(dirty(spark, d))


@register("dq_report_by_day", f"""
with d as (select *, cast("timestamp" as date) as day from ({SQL_DIRTY}) s),
     t as (select day, cast(count(*) as bigint) as total_rows,
                  cast(count_if(id is null) as bigint) as missing_id,
                  cast(count_if(name is null) as bigint) as missing_name,
                  cast(count_if(value is null or isnan(value)) as bigint) as missing_value,
                  cast(count_if("timestamp" is null) as bigint) as missing_timestamp
           from d group by day),
     u as (select day, cast(count(*) as bigint) as distinct_rows from (select distinct * from d) x group by day)
select t.day, total_rows, distinct_rows, total_rows - distinct_rows as duplicates,
       missing_id, missing_name, missing_value, missing_timestamp
from t join u on t.day is not distinct from u.day
""")
def q_dq_report_by_day(spark, d):
    rows = dirty(spark, d)
    return Q.quality_report_by(rows.withColumn("day", F.to_date("timestamp")), "day")


@register("dq_frames_equal", f"""
with l as (select id, name, value, "timestamp", count(*) as n from ({SQL_DIRTY}) x group by all),
     r as (select id, name, value, "timestamp", count(*) as n from ({SQL_CLEAN}) x group by all),
     j as (select coalesce(l.id, r.id) as id, coalesce(l.name, r.name) as name, coalesce(l.value, r.value) as value,
                  coalesce(l."timestamp", r."timestamp") as "timestamp", coalesce(l.n, 0) - coalesce(r.n, 0) as more
           from l full join r on l.id is not distinct from r.id and l.name is not distinct from r.name
                and l.value is not distinct from r.value and l."timestamp" is not distinct from r."timestamp")
select id, name, value, "timestamp", case when more > 0 then 'left_only' else 'right_only' end as side,
       cast(abs(more) as bigint) as copies
from j where more <> 0
""")
def q_frames_equal(spark, d):
    return Q.frames_diff(dirty(spark, d), cleaned(spark, d))


SQL_EDITED = """select doc_id, case when doc_id % 499 = 3 then null else lang end as lang, text, source, n_chars
from (select *, unnest(case when doc_id % 501 = 5 then [1, 2] else [1] end) as copy from documents) d where doc_id % 503 <> 7"""


@register("dq_frames_equal_ranges", f"""
with l as (select doc_id, text, lang, source, n_chars, count(*) as n from documents group by all),
     r as (select doc_id, text, lang, source, n_chars, count(*) as n from ({SQL_EDITED}) e group by all),
     j as (select coalesce(l.doc_id, r.doc_id) as doc_id, coalesce(l.text, r.text) as text, coalesce(l.lang, r.lang) as lang,
                  coalesce(l.source, r.source) as source, coalesce(l.n_chars, r.n_chars) as n_chars, coalesce(l.n, 0) - coalesce(r.n, 0) as more
           from l full join r on l.doc_id is not distinct from r.doc_id and l.text is not distinct from r.text
                and l.lang is not distinct from r.lang and l.source is not distinct from r.source and l.n_chars is not distinct from r.n_chars)
select doc_id, text, lang, source, n_chars, case when more > 0 then 'left_only' else 'right_only' end as side,
       cast(abs(more) as bigint) as copies
from j where more <> 0
""")
def q_frames_equal_ranges(spark, d):
    # a copy of the documents with few rows edited, dropped and repeated: only ranges that differ are exchanged
    docs = table(spark, d, "documents")
    copies = F.explode(F.when(F.col("doc_id") % 501 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    edited = docs.where("doc_id % 503 <> 7").withColumn("lang", F.when(F.col("doc_id") % 499 != 3, F.col("lang"))).select("*", copies.alias("copy"))
    return Q.frames_diff_by_ranges(docs, edited.drop("copy"))


@register("dq_profile_churn", f"""
with c as ({SQL_CHURN})
select 'label' as metric, Churn as "key", cast(count(*) as bigint) as n from c group by Churn
union all
select 'null_count', k, n from (
  select 'CustomerID' as k, cast(count_if(CustomerID is null) as bigint) as n from c
  union all select 'Tenure', cast(count_if(Tenure is null) as bigint) from c
  union all select 'MonthlyCharges', cast(count_if(MonthlyCharges is null) as bigint) from c
  union all select 'TotalCharges', cast(count_if(TotalCharges is null) as bigint) from c
  union all select 'ContractType', cast(count_if(ContractType is null) as bigint) from c
  union all select 'Churn', cast(count_if(Churn is null) as bigint) from c) x
""")
def q_profile_churn(spark, d):
    return M.churn_profile(churn(spark, d), label="Churn",
                           columns=("CustomerID", "Tenure", "MonthlyCharges", "TotalCharges", "ContractType", "Churn"))


@register("dq_churn_statistics", "\nunion all\n".join(_sql_describe_row(c, f"({SQL_CHURN}) c") for c in ("Tenure", "TotalCharges")))
def q_churn_statistics(spark, d):
    return Q.describe(churn(spark, d), ("Tenure", "TotalCharges"), exact_scale=2)


# ---------------------------------------------------------------- 2.8 jobs

@register("pipe_extract", f"""
select *, timestamp '{AS_OF}' as extraction_timestamp, 'events_csv' as source_system from ({SQL_RECORDS}) s
""")
def q_pipe_extract(spark, d):
    base = scratch_dir(spark, "extract")
    recs = records(spark, d)
    write_csv(recs, f"{base}/input/events.csv", timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    landed = flows.extract(spark, f"{base}/input/events.csv", f"{base}/raw", "events_csv", rid="20240201_000000",
                           schema=recs.schema, as_of=AS_OF, export_root=f"{base}/exports")
    return spark.read.parquet(landed.path)


@register("pipe_clean", SQL_CLEAN)
def q_pipe_clean(spark, d):
    return cleaned(spark, d)


@register("pipe_clean_required", f"select * from ({SQL_CLEAN}) s where name is not null")
def q_pipe_clean_required(spark, d):
    return C.clean_records(dirty(spark, d), required_columns=["name"])


@register("pipe_enrich", SQL_ENRICH)
def q_pipe_enrich(spark, d):
    return enriched(spark, d)


@register("pipe_transform", f"""
select * from ({SQL_ENRICH}) a union all select * from ({SQL_ENRICH}) c
union all select * from ({sql_enrich(sql_clean(SQL_RECORDS))}) b
""")
def q_pipe_transform(spark, d):
    base = scratch_dir(spark, "transform")
    recs = records(spark, d)
    write_parquet(dirty(spark, d), f"{base}/raw/extracted_data_dirty")
    write_parquet(dirty(spark, d), f"{base}/raw/extracted_data_again")
    write_csv(recs, f"{base}/raw/events_records.csv", timestamp_format=CSV_TIMESTAMP_FORMAT_MICROS)
    flows.transform(spark, f"{base}/raw", f"{base}/processed", as_of=AS_OF, csv_schema=recs.schema, with_hash=False,
                    export_root=f"{base}/exports")
    return spark.read.parquet(f"{base}/processed/{flows.PROCESSED_PREFIX}*")


@register("pipe_transform_batched", f"""
select *, 'extracted_data_r1' as dataset from ({SQL_ENRICH}) a
union all
select *, 'extracted_data_r2' as dataset from ({sql_enrich(sql_clean(SQL_RECORDS))}) b
""")
def q_pipe_transform_batched(spark, d):
    base = scratch_dir(spark, "batched")
    first = dirty(spark, d)
    write_parquet(first, f"{base}/raw/{flows.RAW_MARKER}_r1")
    write_parquet(records(spark, d), f"{base}/raw/{flows.RAW_MARKER}_r2")
    flows.transform_batched(spark, f"{base}/raw", f"{base}/processed", as_of=AS_OF, with_hash=False,
                            schema=first.schema)
    return spark.read.parquet(f"{base}/processed")


@register("stream_incremental_transform", f"""
select *, 'extracted_data_r1' as dataset from ({SQL_ENRICH}) a
union all select *, 'extracted_data_r2' as dataset from ({sql_enrich(sql_clean(SQL_RECORDS))}) b
union all select *, 'extracted_data_r3' as dataset from ({SQL_ENRICH}) c
""")
def q_stream_incremental(spark, d):
    base = scratch_dir(spark, "incremental")
    raw, out, ckpt = f"{base}/raw", f"{base}/processed", f"{base}/checkpoint"
    first = dirty(spark, d)
    # two datasets land before the first run; the third one's files come one to a micro-batch
    write_parquet(first, f"{raw}/{flows.RAW_MARKER}_r1")
    write_parquet(records(spark, d), f"{raw}/{flows.RAW_MARKER}_r2")
    incremental_transform(spark, raw, first.schema, out, checkpoint=ckpt, as_of=AS_OF, with_hash=False)
    write_parquet(first.repartition(2), f"{raw}/{flows.RAW_MARKER}_r3")
    incremental_transform(spark, raw, first.schema, out, checkpoint=ckpt, as_of=AS_OF, with_hash=False,
                          max_files_per_trigger=1)
    return read_increments(spark, out)


@register("pipe_transform_sql", f"""
select id, lower(trim(name)) as name, value, "timestamp", timestamp '{AS_OF}' as processed_timestamp,
       cast(year("timestamp") as int) as year, cast(month("timestamp") as int) as month,
       case when value < 100 then 'low' when value < 200 then 'medium' else 'high' end as value_category
from ({SQL_DIRTY}) s where value > 0 and name is not null and not isnan(value)
""")
def q_pipe_transform_sql(spark, d):
    return flows.transform_sql(dirty(spark, d), as_of=AS_OF, with_hash=False)


SQL_TWO_RUNS = f"""
select *, 'r1' as run_id from ({SQL_CONFORMED}) a
union all select *, 'r2' as run_id from ({SQL_CONFORMED.replace(SQL_DIRTY, SQL_RECORDS)}) b
"""


def two_runs(spark, d, label):
    """Two runs that share their months; the first one is loaded again."""
    path = f"{scratch_dir(spark, label)}/processed_data"
    first = enriched(spark, d)
    second = E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False)
    for rid, rows in (("r1", first), ("r2", second), ("r1", first)):
        loaded = flows.load(spark, rows, path, as_of=AS_OF, rid=rid)
        flows.verify_load(spark, path, loaded.rows, rid=rid)
    return path


@register("pipe_load", SQL_TWO_RUNS)
def q_pipe_load(spark, d):
    return flows.read_table(spark, two_runs(spark, d, "load"))


@register("pipe_load_versions", f"""
with r1 as (select 'r1' as run_id, * from ({SQL_CONFORMED}) a),
     r2 as (select 'r2' as run_id, * from ({SQL_CONFORMED.replace(SQL_DIRTY, SQL_RECORDS)}) b)
select *, 1 as version from r1
union all select *, 2 from r1 union all select *, 2 from r2
union all select *, 3 from r1 where day <= 15 union all select *, 3 from r2
union all select *, 4 from r2
""")
def q_pipe_load_versions(spark, d):
    # two runs, the first one loaded again with fewer rows and then with none; a load that dies before its commit
    path = f"{scratch_dir(spark, 'load_versions')}/processed_data"
    first = enriched(spark, d)
    second = E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False)
    flows.load(spark, first, path, as_of=AS_OF, rid="r1")
    flows.load(spark, second, path, as_of=AS_OF, rid="r2")
    flows.load(spark, first.where("day <= 15"), path, as_of=AS_OF, rid="r1")
    flows.load(spark, first.where("id < 0 and id > 0"), path, as_of=AS_OF, rid="r1")
    flows.run_table(spark, path).stage(flows.read_table(spark, path))
    read = [flows.read_table(spark, path, version=v).withColumn("version", F.lit(v)) for v in flows.run_table(spark, path).versions()]
    return reduce(DataFrame.unionByName, read)


@register("dedup_rows_across_runs", f"""
with r1 as (select * from ({SQL_CONFORMED}) a), r2 as (select * from ({SQL_CONFORMED.replace(SQL_DIRTY, SQL_RECORDS)}) b)
select *, 'r1' as run_id from r1
union all select *, 'r2' from r2 where not exists (
  select 1 from r1 where r1.id is not distinct from r2.id and r1.name is not distinct from r2.name
    and r1.value is not distinct from r2.value and r1."timestamp" is not distinct from r2."timestamp")
""")
def q_dedup_across_runs(spark, d):
    # the second run, loaded twice, leaves out the rows that the first one has
    path = f"{scratch_dir(spark, 'dedup_runs')}/processed_data"
    columns = records(spark, d).columns
    flows.load(spark, enriched(spark, d), path, as_of=AS_OF, rid="r1", skip_loaded=columns)
    for _ in range(2):
        flows.load(spark, E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False), path,
                   as_of=AS_OF, rid="r2", skip_loaded=columns)
    return flows.read_table(spark, path)


@register("agg_distinct_stored", f"""
with t as (select 'r1' as run_id, * from ({SQL_CLEAN}) a union all select 'r2', * from ({sql_clean(SQL_RECORDS)}) b)
select run_id, cast(count(*) as bigint) as exact, true as within from (select distinct * from t) x group by run_id
union all select null, cast(count(*) as bigint), true from (select distinct id, name, value, "timestamp" from t) y
""")
def q_distinct_stored(spark, d):
    # estimates from stored sketches, held against exact counts: within four standard errors of a sketch of 2 ** 14
    path = two_runs(spark, d, "sketches")
    flows.refresh_sketches(spark, path, f"{path}_sketches")
    columns = records(spark, d).columns
    rows = flows.read_table(spark, path).select("run_id", *columns)
    exact = rows.distinct().groupBy("run_id").agg(F.count(F.lit(1)).alias("exact"))
    exact = exact.unionByName(rows.select(*columns).distinct().agg(F.count(F.lit(1)).alias("exact")).withColumn("run_id", F.lit(None).cast("string")))
    both = exact.alias("e").join(flows.stored_distinct(spark, f"{path}_sketches").alias("s"), F.col("e.run_id").eqNullSafe(F.col("s.run_id")))
    near = F.abs(F.col("distinct_rows") - F.col("exact")) <= F.col("exact") * (4 * 1.04 / 2 ** 7) + 1
    return both.select("e.run_id", "exact", near.alias("within"))


@register("pipe_load_partitioned", f"""
select *, 'r1' as run_id from ({SQL_CONFORMED.replace(SQL_ENRICH, sql_enrich(sql_clean(SQL_FINE)))}) s
""")
def q_pipe_load_partitioned(spark, d):
    # many months and years
    base = scratch_dir(spark, "load_part")
    rows = E.enrich_records(C.clean_records(discounts(spark, d)), as_of=AS_OF, with_hash=False)
    flows.load(spark, rows, base, as_of=AS_OF, rid="r1")
    return flows.read_table(spark, base)


@register("pipe_load_whole", f"""
select *, 'r1' as run_id from ({SQL_CONFORMED.replace(SQL_ENRICH, sql_enrich(sql_clean(SQL_FINE)))}) s
""")
def q_pipe_load_whole(spark, d):
    # the load of pipe_load_partitioned, all years of it
    base = scratch_dir(spark, "load_whole")
    rows = E.enrich_records(C.clean_records(discounts(spark, d)), as_of=AS_OF, with_hash=False)
    flows.load(spark, rows, base, as_of=AS_OF, rid="r1")
    return flows.read_table(spark, base)


@register("pipe_summary", sql_summary(SQL_TWO_RUNS))
def q_pipe_summary(spark, d):
    out = scratch_dir(spark, "summary")
    flows.summarize(spark, two_runs(spark, d, "summary"), out, as_of=AS_OF, exact_scale=2)
    return spark.read.parquet(out)


@register("pipe_summary_incremental", sql_summary(f"""
select year, month, day, value_category, value from ({SQL_CONFORMED}) a where day <= 15
union all select year, month, day, value_category, value from ({SQL_CONFORMED.replace(SQL_DIRTY, SQL_RECORDS)}) b
"""))
def q_summary_incremental(spark, d):
    # summarised after each load; the first run is loaded again with fewer rows, and only its partials are replaced
    path, out = f"{scratch_dir(spark, 'summary_runs')}/processed_data", scratch_dir(spark, "summary_out")
    first = enriched(spark, d)
    second = E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False)
    for rid, rows in (("r1", first), ("r2", second), ("r1", first.where("day <= 15"))):
        flows.load(spark, rows, path, as_of=AS_OF, rid=rid)
        flows.summarize(spark, path, out, as_of=AS_OF, exact_scale=2, partials_path=f"{path}_partials")
    return spark.read.parquet(out)


def two_days(spark, d, label, **books):
    """The whole chain for two runs of one work folder; the last run's result."""
    work = scratch_dir(spark, label)
    flows.end_to_end(spark, dirty(spark, d), work, "events_dirty", as_of=AS_OF, rid="r1", exact_scale=2, **books)
    return flows.end_to_end(spark, records(spark, d), work, "events", as_of=AS_OF, rid="r2", exact_scale=2, **books)


@register("pipe_end_to_end", sql_summary(f"""
select year, month, day, value_category, value from ({SQL_ENRICH}) a
union all select year, month, day, value_category, value from ({sql_enrich(sql_clean(SQL_RECORDS))}) b
"""))
def q_end_to_end(spark, d):
    return spark.read.parquet(two_days(spark, d, "e2e")["summary_path"])


# ---------------------------------------------------------------- 2.10 documented extras

@register("doc_standardize_columns", f"""
select CustomerID as customer_id, Tenure as tenure, MonthlyCharges as monthly_charges,
       TotalCharges as total_charges, ContractType as contract_type, Nation as nation, Region as region,
       UrgentService as urgent_service, HighService as high_service, MediumService as medium_service,
       UnspecifiedService as unspecified_service, LowService as low_service, Churn as churn
from ({SQL_CHURN}) c
""")
def q_standardize(spark, d):
    return E.standardize_columns(churn(spark, d))


@register("doc_anonymize_sha256", f"""
select * replace (sha256(cast(CustomerID as varchar)) as CustomerID) from ({SQL_CHURN}) c
""")
def q_anonymize(spark, d):
    return E.anonymize_sha256(churn(spark, d), ["CustomerID"])


@register("doc_impute", f"""
with d as ({SQL_DIRTY}),
     med as (select median(value) as m from d where not isnan(value)),
     mo as (select name from d where name is not null group by name order by count(*) desc, name limit 1)
select id, coalesce(name, (select name from mo)) as name,
       case when value is null or isnan(value) then (select m from med) else value end as value, "timestamp"
from d
""")
def q_impute(spark, d):
    return impute(dirty(spark, d), {"value": "median", "name": "mode"})


@register("doc_impute_lineitem", """
with m as (select median(case when l_linenumber <> 3 then l_extendedprice end) as m from lineitem)
select l_orderkey, l_linenumber,
       case when l_linenumber = 3 then (select m from m) else l_extendedprice end as price from lineitem
""")
def q_impute_lineitem(spark, d):
    price = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))
    return impute(rows, {"price": "median"})


@register("doc_impute_mean_constant", f"""
with d as ({SQL_DIRTY}),
     mu as (select avg(cast(value as decimal(18,2))) as m from d where not isnan(value))
select coalesce(id, -1) as id, name,
       case when value is null or isnan(value) then (select m from mu) else value end as value, "timestamp"
from d
""")
def q_impute_mean(spark, d):
    return impute(dirty(spark, d), {"value": "mean", "id": ("constant", -1)}, exact_scale=2)


@register("doc_clean_types", f"""
select try_cast(cast(id as varchar) as bigint) as id, name,
       try_cast(cast(value as varchar) as double) as value,
       try_cast(cast("timestamp" as varchar) as timestamp) as "timestamp",
       cast(0 as int) as rejected_fields
from ({SQL_DIRTY}) s
""")
def q_clean_types(spark, d):
    raw = dirty(spark, d)
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return M.clean_types(as_text, {"id": "bigint", "value": "double", "timestamp": "timestamp_ntz"})


@register("doc_clean_types_rejects", f"""
select try_cast(cast(id as varchar) as bigint) as id, name,
       try_cast(case when name = 'error' then cast(value as varchar) || ' usd' else cast(value as varchar) end
                as double) as value,
       try_cast(cast("timestamp" as varchar) as timestamp) as "timestamp",
       cast(case when name = 'error' then 1 else 0 end as int) as rejected_fields
from ({SQL_RECORDS}) s
""")
def q_clean_types_rejects(spark, d):
    # text extract in which the values of 'error' events carry a unit suffix
    recs = records(spark, d)
    text = F.col("value").cast("string")
    as_text = recs.select(
        F.col("id").cast("string").alias("id"), "name",
        F.when(F.col("name") == "error", F.concat(text, F.lit(" usd"))).otherwise(text).alias("value"),
        F.col("timestamp").cast("string").alias("timestamp"),
    )
    return M.clean_types(as_text, {"id": "bigint", "value": "double", "timestamp": "timestamp_ntz"})


@register("doc_tenure_bucket", f"select *, {SQL_TENURE_BAND} as TenureBand from ({SQL_CHURN}) c")
def q_tenure_bucket(spark, d):
    return M.add_tenure_band(churn(spark, d))


SQL_SERVICE_COUNT = " + ".join(
    f"(case when {c} = 'Yes' then 1 else 0 end)"
    for c in ("UrgentService", "HighService", "MediumService", "UnspecifiedService", "LowService"))


@register("doc_service_count", f"select *, cast({SQL_SERVICE_COUNT} as int) as ServiceCount from ({SQL_CHURN}) c")
def q_service_count(spark, d):
    return M.add_service_count(churn(spark, d))


@register("doc_quality_score", f"""
select *, ((case when id is not null then 1 else 0 end) + (case when name is not null then 1 else 0 end)
          + (case when value > 0 and not isnan(value) then 1 else 0 end)
          + (case when "timestamp" is not null then 1 else 0 end)) / 4.0::double as quality_score,
       ((case when id is not null then 1 else 0 end) + (case when name is not null then 1 else 0 end)
          + (case when value > 0 and not isnan(value) then 1 else 0 end)
          + (case when "timestamp" is not null then 1 else 0 end)) = 4 as quality_ok
from ({SQL_DIRTY}) s
""")
def q_quality_score(spark, d):
    return M.quality_score(dirty(spark, d), M.record_rules())


@register("doc_dim_contract", f"""
select distinct ContractType, {sql_key('ContractType')} as contract_key from ({SQL_CHURN}) c
""")
def q_dim_contract(spark, d):
    return M.dimension(churn(spark, d), ["ContractType"], "contract_key")


@register("doc_dim_service", f"""
select distinct UrgentService, HighService, MediumService, UnspecifiedService, LowService,
       {sql_key(*M.SERVICE_COLUMNS)} as service_key
from ({SQL_CHURN}) c
""")
def q_dim_service(spark, d):
    return M.dimension(churn(spark, d), list(M.SERVICE_COLUMNS), "service_key")


@register("doc_dim_customer", f"""
select CustomerID, Nation, Region, {SQL_TENURE_BAND} as TenureBand,
       {sql_key('CustomerID')} as customer_key
from ({SQL_CHURN}) c
""")
def q_dim_customer(spark, d):
    return M.customer_dimension(churn(spark, d))


@register("doc_fact", f"""
select {sql_key('CustomerID')} as customer_key,
       {sql_key('ContractType')} as contract_key,
       {sql_key(*M.SERVICE_COLUMNS)} as service_key,
       Tenure, MonthlyCharges, TotalCharges, cast({SQL_SERVICE_COUNT} as int) as ServiceCount,
       case when Churn = 'Yes' then 1 else 0 end as churned
from ({SQL_CHURN}) c
""")
def q_fact(spark, d):
    return M.churn_fact(churn(spark, d))


@register("doc_fact_joined", ORACLE_SQL["doc_fact"])
def q_fact_joined(spark, d):
    # materialise the churn table once; dimensions and fact all read it
    path = scratch_dir(spark, "churn")
    write_parquet(churn(spark, d), path)
    c = spark.read.parquet(path)
    return M.churn_fact_joined(c, M.customer_dimension(c), M.dimension(c, ["ContractType"], "contract_key"),
                               M.dimension(c, list(M.SERVICE_COLUMNS), "service_key"))


@register("doc_churn_summary", f"""
with c as (select *, {SQL_TENURE_BAND} as TenureBand from ({SQL_CHURN}) x),
     u as (select 'ContractType' as dimension, ContractType as category, Churn from c
           union all select 'Region', Region, Churn from c
           union all select 'TenureBand', TenureBand, Churn from c)
select dimension, category, cast(count(*) as bigint) as customers,
       cast(count_if(Churn = 'Yes') as bigint) as churned,
       cast(count_if(Churn = 'Yes') as double) / count(*) as churn_rate
from u group by dimension, category
""")
def q_churn_summary(spark, d):
    return M.churn_summary(M.add_tenure_band(churn(spark, d)), ["ContractType", "Region", "TenureBand"])


@register("doc_raw_snapshot", "select * from events")
def q_raw_snapshot(spark, d):
    snap = flows.snapshot_source(spark, table(spark, d, "events"), scratch_dir(spark, "snapshot"), "20240201_000000")
    return spark.read.parquet(snap.path)


SQL_COUNTS = f"""
with raw as (select 'r1' as run_id, count(*) as landed, count(distinct (id, name, value, "timestamp")) as once from ({SQL_DIRTY}) a
             union all select 'r2', count(*), count(distinct (id, name, value, "timestamp")) from ({SQL_RECORDS}) b),
     kept as (select 'r1' as run_id, count(*) as loaded from ({SQL_CLEAN}) a
              union all select 'r2', count(*) from ({sql_clean(SQL_RECORDS)}) b),
     groups as (select 'r1' as run_id, count(*) as summary from ({sql_summary(SQL_ENRICH)}) a
                union all select 'r2', count(*) from (
                  select distinct year, month, day, value_category from (
                    select year, month, day, value_category from ({SQL_ENRICH}) a
                    union all select year, month, day, value_category from ({sql_enrich(sql_clean(SQL_RECORDS))}) b)) c),
     n as (select * from raw join kept using (run_id) join groups using (run_id))
"""


@register("doc_pipeline_metrics", SQL_COUNTS + """
select run_id, 'extract' as stage, null::bigint as rows_in, landed::bigint as rows_out, null::bigint as rejected,
       null::double as error_rate, null::double as quality_score, 'ok' as status from n
union all select run_id, 'transform', landed, loaded, landed - loaded, (landed - loaded)::double / landed,
       1.0 - (landed - once)::double / landed, 'ok' from n
union all select run_id, 'load', loaded, loaded, null, null, null, 'ok' from n
union all select run_id, 'summary', loaded, summary, null, null, null, 'ok' from n
""")
def q_pipeline_metrics(spark, d):
    books = scratch_dir(spark, "e2e_books")
    two_days(spark, d, "e2e_metrics", metrics_path=books)
    return spark.read.parquet(books).select("run_id", "stage", "rows_in", "rows_out", "rejected", "error_rate",
                                            "quality_score", "status")


@register("doc_load_audit", SQL_COUNTS + "select run_id, loaded::bigint as rows, 'ok' as status from n")
def q_load_audit(spark, d):
    books = scratch_dir(spark, "e2e_books")
    two_days(spark, d, "e2e_audit", audit_path=books)
    return spark.read.parquet(books).select("run_id", "rows", "status")


# ---------------------------------------------------------------- lineage and fingerprints

@register("doc_row_lineage", "select event_id, 'events.parquet' as source_file from events")
def q_row_lineage(spark, d):
    return with_source_file(table(spark, d, "events"), name_only=True).select("event_id", "source_file")


def _sql_fingerprint(name: str, *columns: str) -> str:
    # the first 15 hex digits of the row's hash, digit by digit
    digits = " + ".join(f"(strpos('0123456789abcdef', substr(k, {i + 1}, 1)) - 1)::hugeint * {16 ** (14 - i)}::hugeint" for i in range(15))
    return f"""select '{name}.parquet' as file, count(*)::bigint as rows, cast(sum({digits})::hugeint as varchar) as digest
        from (select {sql_key(*columns)} as k from {name}) x"""


FINGERPRINTED = {"documents": ("doc_id", "text", "lang", "source", "n_chars"), "benchmark": ("item_id", "text"),
                 "labels": ("doc_id", "quality", "toxic")}


@register("doc_file_fingerprint", "\nunion all\n".join(_sql_fingerprint(t, *c) for t, c in FINGERPRINTED.items()))
def q_fingerprint(spark, d):
    found = [M.file_fingerprints(spark, f"{d.rstrip('/')}/{t}.parquet") for t in FINGERPRINTED]
    file = F.element_at(F.split("path", "/"), -1)
    return reduce(DataFrame.unionByName, found).select(file.alias("file"), "rows", "digest")


@register("doc_file_changes", """
with n as (select doc_id % 4 as k, count(*) as rows from documents group by 1)
select 'extracted_data_' || case k when 0 then 'cut_anew' when 1 then 'edited' when 2 then 'gone' else 'as_it_was' end as dataset,
       case k when 1 then 'changed' when 2 then 'removed' else 'unchanged' end as change,
       case when k = 2 then null else cast(rows as bigint) end as rows, cast(rows as bigint) as rows_before from n
union all select 'extracted_data_late', 'new', cast(count(*) as bigint), null from documents
""")
def q_file_changes(spark, d):
    # two looks at a folder: one dataset is written anew in other files, one has another text, one is gone, one is new
    base, docs = scratch_dir(spark, "changes"), table(spark, d, "documents")
    names = ["cut_anew", "edited", "gone", "as_it_was"]
    parts = {n: docs.where(F.pmod("doc_id", F.lit(4)) == i) for i, n in enumerate(names)}
    for n, rows in parts.items():
        write_parquet(rows, f"{base}/one/{flows.RAW_MARKER}_{n}")
    changes.look(spark, f"{base}/one", f"{base}/index", flows.RAW_MARKER)
    text = F.when(F.col("doc_id") == F.lit(1), F.lit("another")).otherwise(F.col("text"))
    later = {"cut_anew": parts["cut_anew"].repartition(5), "edited": parts["edited"].withColumn("text", text), "as_it_was": parts["as_it_was"], "late": docs}
    for n, rows in later.items():
        write_parquet(rows, f"{base}/two/{flows.RAW_MARKER}_{n}")
    changes.look(spark, f"{base}/two", f"{base}/index", flows.RAW_MARKER)
    return changes.changes(spark, f"{base}/index")


@register("load_compacted", f"""
select * exclude (run_id), run_id, true as compact from ({SQL_TWO_RUNS}) t
""")
def q_load_compacted(spark, d):
    # two runs in many small files; compaction leaves the rows, and no folder more files than its bytes need
    path = f"{scratch_dir(spark, 'compacted')}/processed_data"
    loaded = flows.run_table(spark, path)
    second = E.enrich_records(C.clean_records(records(spark, d)), as_of=AS_OF, with_hash=False)
    for rid, rows in (("r1", enriched(spark, d)), ("r2", second)):
        conformed = conform_to_schema(E.stamp_timestamps(rows, ["load_timestamp"], as_of=AS_OF), PROCESSED_SCHEMA)
        loaded.commit(loaded.stage(conformed.withColumn("run_id", F.lit(rid)).repartition(6), ("year", "month"), rebalance=False))
    target = 64 << 10
    before = file_sizes(loaded).select(F.split_part("folder", F.lit("run_id="), F.lit(2)).alias("part"), F.ceil(F.col("bytes") / target).alias("bound"))
    bounds = scratch_dir(spark, "bounds")
    write_parquet(before, bounds)
    compact(loaded, target, ("year", "month"))
    after = file_sizes(loaded).select(F.split_part("folder", F.lit("run_id="), F.lit(2)).alias("part"), "files")
    crowded = after.join(spark.read.parquet(bounds), "part", "left").agg(F.count_if((F.col("files") > F.col("bound")) | F.col("bound").isNull()).alias("n")).scalar()
    return flows.read_table(spark, path).withColumn("compact", crowded == 0)
