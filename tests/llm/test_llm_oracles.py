"""Queries with SQL match it on whole tables."""

import duckdb
import pytest
from llm_cases import scratch  # noqa: F401

from assay.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    rows = got.collect()
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(repr([norm(r[c]) for c in columns]) for r in rows) == sorted(repr([norm(v) for v in r]) for r in found.fetchall())


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_url_filter", "op4_license_scan", "op9_source_mix", "op10_exact_dedup"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
