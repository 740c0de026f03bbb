"""Data-driven suites: many suites and checks held in a table (rows 33,
44-47, 95)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import checks as C
from assay.operators import reports as R
from assay.operators.graph import propagate_skips
from assay.operators.ordering import cascade_status
from assay.plans import standins as S
from assay.plans.registry import query

col = F.col


@query("latest_scorecard", """
WITH r AS (SELECT user_id, event_type, ts, event_id, event_type <> 'error' AS ok FROM events),
l AS (SELECT user_id, event_type, arg_max_null(ok, (ts, event_id)) AS ok FROM r GROUP BY user_id, event_type)
SELECT user_id, CAST(count(*) AS BIGINT) AS n_checks, CAST(count_if(ok) AS BIGINT) AS score,
  CAST(count(*) AS BIGINT) AS max_score,
  CAST(floor(100.0 * count_if(ok) / count(*)) AS INTEGER) AS percentage,
  floor(100.0 * count_if(ok) / count(*)) = 100 AS passed
FROM l GROUP BY user_id""")
def latest_scorecard(t):
    """Row 33: results keyed by check id (user x event type), last write by
    (ts, event_id) wins, then score per suite.  Two partial aggregations."""
    e = t.events.select("user_id", "event_type", "ts", "event_id")
    return C.latest_results(e, "user_id", "event_type", col("event_type") != "error", ["ts", "event_id"])


@query("isolated_suite", """
WITH a AS (SELECT count(*) AS n, count_if(o_custkey % 7 = 0) AS zeros, coalesce(bool_and(o_totalprice > 0), true) AS positive FROM orders),
c AS (SELECT * FROM (VALUES (1, 'priced'), (2, 'per_customer_class'), (3, 'behind_it'), (4, 'has_rows')) v(seq, check_id))
SELECT CAST(seq AS INTEGER) AS seq, check_id,
  CASE seq WHEN 1 THEN CASE WHEN positive THEN 'passed' ELSE 'failed' END WHEN 2 THEN CASE WHEN zeros > 0 THEN 'failed' ELSE 'passed' END
    WHEN 3 THEN CASE WHEN zeros > 0 THEN 'skipped' ELSE 'passed' END ELSE CASE WHEN n > 0 THEN 'passed' ELSE 'failed' END END AS status,
  seq = 2 AND zeros > 0 AS raised
FROM a, c""")
def isolated_suite(t):
    """Row 101: a suite with a check that divides by zero: it fails alone,
    with a message, the check behind it is skipped and the others run."""
    o = t.orders
    s = (C.Suite("orders").test_true(col("o_totalprice") > 0, "prices are positive", test_case_id="priced")
         .test_true(col("o_totalprice") / (col("o_custkey") % 7) > 0, "price per class", test_case_id="per_customer_class", depends_on=[])
         .test_true(col("o_totalprice") > 0, "after it", test_case_id="behind_it", depends_on="per_customer_class")
         .test(F.count(F.lit(1)) > 0, "there are orders", test_case_id="has_rows", depends_on=[]))
    r = s.run(o, isolated=True)
    raised = col("message") != "" if "message" in r.columns else F.lit(False)
    return r.select("seq", "check_id", "status", raised.alias("raised"))


@query("skip_cascade_linear", """
WITH r AS (SELECT user_id, event_id, ts, event_type <> 'error' AS ok FROM events),
w AS (SELECT *, coalesce(bool_or(NOT ok) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped FROM r),
s AS (SELECT user_id, event_id, CASE WHEN skipped THEN 'skipped' WHEN ok THEN 'passed' ELSE 'failed' END AS status FROM w),
p AS (SELECT *, CAST(CASE WHEN status = 'passed' THEN 1 ELSE 0 END AS INTEGER) AS points FROM s),
tot AS (SELECT user_id, CAST(sum(points) AS BIGINT) AS score, CAST(count(*) AS BIGINT) AS max_score FROM p GROUP BY user_id)
SELECT p.*, score, max_score, CAST(floor(100.0 * score / max_score) AS INTEGER) AS percentage
FROM p JOIN tot USING (user_id)""")
def skip_cascade_linear(t):
    """Row 44: every user's events form a default-chained suite; after the
    first error every later check is skipped.  Aggregate + join, no per-user sort."""
    e = t.events.select("user_id", "event_id", "ts", (col("event_type") != "error").alias("ok"))
    st = cascade_status(e, ["user_id"], ["ts", "event_id"], col("ok"))
    st = st.select("user_id", "event_id", "status",
                   F.when(col("status") == "passed", 1).otherwise(0).alias("points"))
    tot = st.groupBy("user_id").agg(F.sum("points").cast("bigint").alias("score"),
                                    F.count(F.lit(1)).alias("max_score"))
    return st.join(tot, "user_id").withColumn(
        "percentage", F.floor(F.lit(100.0) * col("score") / col("max_score")).cast("int"))


@query("skip_cascade_dag", """
WITH RECURSIVE n AS (SELECT o_orderkey AS id, o_totalprice <= 450000 AS ok FROM orders),
anc(id, a) AS (
  SELECT n.id, p.id FROM n JOIN n p ON p.id = n.id // 2 WHERE n.id > 0
  UNION ALL
  SELECT anc.id, p.id FROM anc JOIN n p ON p.id = anc.a // 2 WHERE anc.a > 0
),
sk AS (SELECT DISTINCT anc.id FROM anc JOIN n ON n.id = anc.a WHERE NOT n.ok)
SELECT n.id AS o_orderkey,
  CASE WHEN sk.id IS NOT NULL THEN 'skipped' WHEN n.ok THEN 'passed' ELSE 'failed' END AS status
FROM n LEFT JOIN sk ON n.id = sk.id""")
def skip_cascade_dag(t):
    """Row 45: explicit dependency DAG (order k depends on order k div 2);
    a check is skipped when any ancestor failed."""
    o = t.orders.select(col("o_orderkey").alias("id"), (col("o_totalprice") <= 450000).alias("ok"))
    edges = o.where(col("id") > 0).select(col("id").alias("child"), (col("id") / 2).cast("bigint").alias("parent"))
    edges = edges.join(o.select(col("id").alias("parent")), "parent", "left_semi")
    st = propagate_skips(o, edges)
    return st.select(col("id").alias("o_orderkey"), "status")


@query("fail_fast_trace", f"""
WITH r AS ({S.RUN_RECORDS_SQL}),
w AS (SELECT *, coalesce(bool_or(result_state = 'FAILED') OVER (PARTITION BY suite_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS after_fail FROM r)
SELECT suite_id, test_id, CASE WHEN after_fail THEN 'UNKNOWN' ELSE result_state END AS logged_state FROM w""")
def fail_fast_trace(t):
    """Row 46: after the first FAILED test of a suite the rest are logged UNKNOWN."""
    r = S.run_records(t).select("suite_id", "test_id", "ts", "event_id", "result_state")
    st = cascade_status(r, ["suite_id"], ["ts", "event_id"], col("result_state") != "FAILED",
                        passed="keep", failed="keep", skipped="UNKNOWN", status_col="_st")
    return st.select("suite_id", "test_id",
                     F.when(col("_st") == "UNKNOWN", "UNKNOWN").otherwise(col("result_state")).alias("logged_state"))


@query("latest_run_verdict", f"""
WITH runs AS ({S.JOB_RUNS_SQL}),
l AS (SELECT job_id, arg_max_null(life_cycle_state, (start_time, run_id)) AS life_cycle_state,
             arg_max_null(result_state, (start_time, run_id)) AS result_state,
             CAST(count(*) AS BIGINT) AS n_runs
      FROM runs GROUP BY job_id)
SELECT c.c_custkey AS job_id, coalesce(l.n_runs, 0) AS n_runs, l.life_cycle_state, l.result_state,
  CASE WHEN l.job_id IS NULL THEN 'NO_RUNS' WHEN l.life_cycle_state <> 'TERMINATED' THEN 'PENDING'
       WHEN l.result_state = 'SUCCESS' THEN 'OK' ELSE 'FAILED' END AS verdict
FROM customer c LEFT JOIN l ON c.c_custkey = l.job_id""")
def latest_run_verdict(t):
    """Row 47: latest run per job by start time (``max_by``), left-joined to
    the expected jobs so jobs with zero runs are reported."""
    jobs = t.customer.select(col("c_custkey").alias("job_id"))
    return R.latest_run_verdict(jobs, S.job_runs(t), "job_id", ["start_time", "run_id"], "life_cycle_state",
                                "result_state")


@query("check_sequence", """
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  count_if(role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END) = 0 AS ordered_ok,
  count_if(role NOT IN ('user', 'assistant')) = 0 AND bool_or(role = 'user')
    AND (count(*) < 2 OR bool_or(role = 'assistant')) AS unordered_ok,
  count_if(role = 'user') = CAST(ceil(count(*) / 2.0) AS BIGINT)
    AND count_if(role = 'assistant') = count(*) // 2 AS multiset_ok
FROM conversations GROUP BY conv_id""")
def check_sequence(t):
    """Row 95 (and 61): per conversation, roles ordered by turn against the
    expected alternation -- ordered, unordered (membership both ways plus
    equal length) and strict multiset -- all as aggregates, no list collect."""
    c = t.conversations.select("conv_id", "turn", "role")
    expected = F.when(col("turn") % 2 == 0, "user").otherwise("assistant")
    n = F.count(F.lit(1))
    return c.groupBy("conv_id").agg(
        n.alias("n_turns"),
        (F.count_if(col("role") != expected) == 0).alias("ordered_ok"),
        ((F.count_if(~col("role").isin("user", "assistant")) == 0) & F.bool_or(col("role") == "user")
         & ((n < 2) | F.bool_or(col("role") == "assistant"))).alias("unordered_ok"),
        ((F.count_if(col("role") == "user") == F.ceil(n / 2.0).cast("bigint"))
         & (F.count_if(col("role") == "assistant") == F.floor(n / 2).cast("bigint"))).alias("multiset_ok"))

