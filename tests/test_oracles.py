"""Core queries against their DuckDB twins on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from claimloom.plans import claim_queries, extra_queries, lane_queries, planning_queries, reference_queries, sink_queries, source_queries, units_queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
CORE = reference_queries.SQL | units_queries.SQL | source_queries.SQL | planning_queries.SQL | extra_queries.SQL | claim_queries.SQL | lane_queries.SQL | sink_queries.SQL


def rows(df: pd.DataFrame) -> list:
    return sorted(tuple(repr(round(x, 6)) if isinstance(x, float) else str(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(DATA):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_equals_its_twin(spark, duck, name):
    got, want = entry.queries()[name](spark, DATA).toPandas(), duck.execute(CORE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
