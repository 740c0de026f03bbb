"""Run registered queries on Spark and their oracle SQL on DuckDB, compare
row count, column names and an order-insensitive value hash.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from assay.plans import ORACLES, QUERIES  # noqa: E402
from assay.session import get_session  # noqa: E402
from assay.sources.tables import TABLES  # noqa: E402


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
                 "array<string>": "VARCHAR[]", "float": "FLOAT"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
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
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest(), keyed


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    names = args or sorted(QUERIES)
    spark = get_session()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {e!r}"[:2000])
            traceback.print_exc(limit=3)
            bad += 1
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s), no oracle")
            ok += 1
            continue
        try:
            res = con.execute(ORACLES[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {e!r}"[:2000])
            bad += 1
            continue
        problems = []
        stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
        dtypes = {d[0]: str(d[1]) for d in res.description}
        tdiff = {c: (stypes.get(c), dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
        if tdiff:
            print(f"TYPE {name}: {tdiff}")
        if sorted(scols) != sorted(dcols):
            problems.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not problems:
            hs, ks = digest(scols, srows)
            hd, kd = digest(dcols, drows)
            if hs != hd:
                only_s = sorted(set(ks) - set(kd))[:3]
                only_d = sorted(set(kd) - set(ks))[:3]
                problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
        if problems:
            bad += 1
            print(f"FAIL {name}: " + "; ".join(problems)[:3000])
        else:
            ok += 1
            print(f"OK   {name}: {len(srows)} rows ({ts:.1f}s)")
    print(f"{ok} ok, {bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
