"""Every registered query runs at sf0.001 and, where it has one, matches its
DuckDB oracle (row count, column names, order-insensitive values)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from assay.plans import ORACLES, QUERIES
from assay.sources.tables import TABLES

from conftest import SMOKE


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(df.columns) > 0
        return
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert canon(df.columns, rows) == canon(cols, want)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() == 10
    assert set(E.oracle_sql()) <= set(E.queries())
    assert "status" in df.columns and "score" in df.columns


def test_every_query_names_its_survey_rows():
    import re

    for name, fn in QUERIES.items():
        assert re.search(r"[Rr]ows? [0-9]", fn.__doc__ or ""), name
    assert set(ORACLES) == set(QUERIES)
