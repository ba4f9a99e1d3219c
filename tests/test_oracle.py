"""Every registered query against its DuckDB twin (rows, names, values)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from farelake.plans import catalog
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_of_the_catalog_has_a_twin():
    rows_only = set(catalog.queries()) - set(SQL)
    assert rows_only <= set(), f"queries without SQL twin: {sorted(rows_only)}"


@pytest.mark.parametrize("name", sorted(set(SQL) & set(catalog.queries())))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    srows = sdf.collect()
    cur = duck.execute(SQL[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert forbidden not in plan, f"{name}: {forbidden} in plan"
    scols, smulti = canon(sdf.columns, srows)
    dcols, dmulti = canon(dcols, drows)
    assert scols == dcols
    assert len(srows) == len(drows)
    assert smulti == dmulti


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "trip_date",
        "vendor_name",
        "total_trips",
        "daily_revenue_in_M",
        "avg_tip",
        "avg_tip_percentage",
        "longest_trip_in_miles",
    ]
