"""Every registered query against its DuckDB twin (sf0.001, exact hash)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from sluice.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import digest, duck

ORACLE = catalog.ORACLE_SQL
QUERIES = catalog.QUERIES


def test_every_query_is_registered_with_a_callable():
    assert len(QUERIES) >= 50
    assert set(ORACLE) <= set(QUERIES)
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_rows = [tuple(r) for r in df.collect()]
    cols, want_rows = duck(SF_SMALL, ORACLE[name])
    assert sorted(df.columns) == sorted(cols)
    assert len(got_rows) == len(want_rows)
    assert digest(df.columns, got_rows)[0] == digest(cols, want_rows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "month", "day", "value_category", "record_count", "avg_value",
                          "min_value", "max_value", "summary_timestamp"]


def test_query_names():
    import inspect
    import re

    for name, fn in QUERIES.items():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name), name
        assert name != "pipeline" and not re.match(r"op\d+_", name), name
        assert list(inspect.signature(fn).parameters)[:2] == ["spark", "d"], name
