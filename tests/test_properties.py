"""Property checks: cleaning is idempotent and matches a plain-Python model;
bands follow their bounds; the one-pass report matches a direct count."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice.functions.columns import VALUE_BAND_DEFAULT, VALUE_BANDS
from sluice.operators import clean as C
from sluice.operators import enrich as E
from sluice.operators import quality as Q

NAMES = st.sampled_from([None, "a", " A", "a ", "B", "  b  ", "c"])
VALUES = st.one_of(st.none(), st.just(float("nan")), st.floats(min_value=-300, max_value=300))
STAMPS = st.sampled_from([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5)])
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), NAMES, VALUES, STAMPS), max_size=25)
SCHEMA = "id bigint, name string, value double, timestamp timestamp_ntz"
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_clean(rows):
    out = set()
    for i, n, v, t in rows:
        if i is None and n is None and v is None and t is None:
            continue
        if v is None or v != v or not v > 0:
            continue
        out.add((i, n.lower().strip(" ") if n is not None else None, v, t))
    return out


@SETTINGS
@given(ROWS)
def test_clean_matches_model_and_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    once = C.clean_records(df)
    got = {tuple(r) for r in once.collect()}
    assert got == model_clean(rows)
    assert once.count() == len(got)
    assert {tuple(r) for r in C.clean_records(once).collect()} == got


@SETTINGS
@given(ROWS)
def test_report_matches_direct_counts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    rep = Q.quality_summary(df)
    assert rep["total_rows"] == len(rows)
    assert rep["distinct_rows"] == df.distinct().count()
    assert rep["null_counts"]["value"] == sum(1 for r in rows if r[2] is None or r[2] != r[2])
    assert rep["null_counts"]["name"] == sum(1 for r in rows if r[1] is None)


@SETTINGS
@given(st.lists(VALUES, max_size=20))
def test_bands_follow_bounds(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value double")
    for r in E.add_band(df).collect():
        v = r["value"]
        want = VALUE_BAND_DEFAULT
        for bound, label in VALUE_BANDS:
            if v is not None and v == v and v < bound:
                want = label
                break
        assert r["value_category"] == want
