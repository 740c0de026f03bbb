"""Helpers that write oracle SQL (DuckDB dialect) for recurring shapes.

The oracle for a check suite resolves skips with a recursive walk over the
check list carrying the list of failed checks -- a formulation independent
of the Column-expression one used on the Spark side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from assay.operators import checks as C


@dataclass
class Spec:
    check_id: str
    description: str
    spark: object            # callable -> aggregate boolean Column, or Column
    sql: str                 # aggregate boolean SQL
    points: int = 1
    depends_on: list[str] | None = None
    hint: str | None = None
    spark_actual: object = None
    sql_actual: str | None = None


def to_checks(specs: list[Spec]) -> list[C.Check]:
    out = []
    for s in specs:
        ok = s.spark() if callable(s.spark) and not isinstance(s.spark, Column) else s.spark
        act = s.spark_actual() if callable(s.spark_actual) and not isinstance(s.spark_actual, Column) else s.spark_actual
        out.append(C.Check(s.check_id, s.description, ok, points=s.points, depends_on=s.depends_on,
                           hint=s.hint, actual=act))
    return out


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def html_escape_sql(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), '''', '&#x27;')")


def suite_sql(from_sql: str, suite: str, specs: list[Spec]) -> str:
    ids = {s.check_id: i + 1 for i, s in enumerate(specs)}
    aggs, rows, oks, acts = [], [], [], []
    for i, s in enumerate(specs, start=1):
        aggs.append(f"({s.sql}) AS ok{i}")
        if s.sql_actual is not None:
            aggs.append(f"CAST(({s.sql_actual}) AS VARCHAR) AS act{i}")
            acts.append(f"WHEN {i} THEN act{i}")
        if s.depends_on is None:
            deps = [i - 1] if i > 1 else []
        else:
            deps = [ids[d] for d in s.depends_on if d in ids and ids[d] < i]
        hint = q(s.hint) if s.hint is not None else "NULL"
        rows.append(f"({i}, {q(s.check_id)}, {q(s.description)}, {int(s.points)}, "
                    f"CAST({deps} AS INTEGER[]), {hint})")
        oks.append(f"WHEN {i} THEN ok{i}")
    act_case = f"CASE seq {' '.join(acts)} END" if acts else "NULL"
    return f"""
WITH RECURSIVE src AS ({from_sql}),
a AS (SELECT {', '.join(aggs)} FROM src),
spec AS (SELECT * FROM (VALUES {', '.join(rows)}) v(seq, check_id, description, max_points, deps, hint)),
raw AS (SELECT spec.*, coalesce(CASE seq {' '.join(oks)} END, false) AS ok, {act_case} AS act FROM spec, a),
walk(seq, failed_list, skipped) AS (
  SELECT seq, CASE WHEN ok THEN CAST([] AS INTEGER[]) ELSE [seq] END, false FROM raw WHERE seq = 1
  UNION ALL
  SELECT r.seq,
    CASE WHEN list_has_any(w.failed_list, r.deps) OR NOT r.ok THEN list_append(w.failed_list, r.seq) ELSE w.failed_list END,
    list_has_any(w.failed_list, r.deps)
  FROM walk w JOIN raw r ON r.seq = w.seq + 1
),
res AS (
  SELECT {q(suite)} AS suite, CAST(raw.seq AS INTEGER) AS seq, check_id, description,
    CASE WHEN w.skipped THEN 'skipped' WHEN ok THEN 'passed' ELSE 'failed' END AS status,
    CAST(max_points AS INTEGER) AS max_points,
    CASE WHEN NOT w.skipped AND NOT ok AND hint IS NOT NULL THEN
      replace(replace(hint, '[[ACTUAL_VALUE]]', {html_escape_sql("coalesce(act, 'None')")}),
              '[[LEN_ACTUAL_VALUE]]', CAST(length(coalesce(act, 'None')) AS VARCHAR)) END AS hint,
    (NOT w.skipped AND ok) AS passed
  FROM raw JOIN walk w ON raw.seq = w.seq
),
res2 AS (SELECT *, CAST(CASE WHEN passed THEN max_points ELSE 0 END AS INTEGER) AS points FROM res),
tot AS (SELECT suite, CAST(sum(points) AS BIGINT) AS score, CAST(sum(max_points) AS BIGINT) AS max_score
        FROM res2 GROUP BY suite)
SELECT res2.*, tot.score, tot.max_score,
  CAST(CASE WHEN max_score = 0 THEN 0 ELSE floor(100.0 * score / max_score) END AS INTEGER) AS percentage,
  CAST(CASE WHEN max_score = 0 THEN 0 ELSE floor(100.0 * score / max_score) END AS INTEGER) = 100 AS suite_passed
FROM res2 JOIN tot USING (suite)
"""
