"""Stand-ins for records the reference fetched from services, derived from
the driver tables by deterministic column expressions (FIXTURES.md §3).

Each derivation exists twice: as a DataFrame builder and as a SQL fragment
the oracles embed, so both sides read the same whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the stand-ins.
NOW = "2024-01-31 00:00:00"
WORKSPACE_ID = "9876543210"


def now_col():
    return F.lit(NOW).cast("timestamp_ntz")


# -- run records from events ---------------------------------------------------

def run_records(t) -> DataFrame:
    """events -> run log: suite = user, test = event, state by type, duration ms."""
    e = t.events
    return e.select(
        F.col("event_id"), F.col("ts"), F.col("user_id"),
        F.col("user_id").cast("string").alias("suite_id"),
        F.col("event_id").cast("string").alias("test_id"),
        F.when(F.col("event_type") == "error", "FAILED")
         .when(F.col("event_type") == "signup", "IGNORED")
         .otherwise("SUCCESS").alias("result_state"),
        F.round(F.col("value") * 1000).cast("bigint").alias("execution_duration"),
        F.col("event_type"), F.col("value"), F.col("props"))


RUN_RECORDS_SQL = """
  SELECT event_id, ts, user_id, CAST(user_id AS VARCHAR) AS suite_id, CAST(event_id AS VARCHAR) AS test_id,
    CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'signup' THEN 'IGNORED' ELSE 'SUCCESS' END AS result_state,
    CAST(round(value * 1000) AS BIGINT) AS execution_duration, event_type, value, props
  FROM events"""


def job_runs(t) -> DataFrame:
    """events -> job runs: job = user, run = event, start = ts."""
    e = t.events
    return e.select(
        F.col("user_id").alias("job_id"), F.col("event_id").alias("run_id"), F.col("ts").alias("start_time"),
        F.when(F.col("event_id") % 97 == 0, "RUNNING").otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
         .when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("result_state"))


JOB_RUNS_SQL = """
  SELECT user_id AS job_id, event_id AS run_id, ts AS start_time,
    CASE WHEN event_id % 97 = 0 THEN 'RUNNING' ELSE 'TERMINATED' END AS life_cycle_state,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state
  FROM events"""


# -- users from customer -------------------------------------------------------

def users(t) -> DataFrame:
    c = t.customer
    return c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                    F.concat(F.lower("c_name"), F.lit("@example.com")).alias("username"),
                    F.lit(WORKSPACE_ID).alias("workspace_id"))


USERS_SQL = f"""
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
    lower(c_name) || '@example.com' AS username, '{WORKSPACE_ID}' AS workspace_id
  FROM customer"""


# -- manifests from pages.url --------------------------------------------------

def page_paths(t) -> DataFrame:
    """url without scheme, query and fragment -> '/host/a/b' file path."""
    p = t.pages.select("page_id", "url")
    path = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace("url", r"^[a-zA-Z]+://", ""), r"[?#].*$", ""))
    return p.select("page_id", path.alias("path"))


PAGE_PATHS_SQL = """
  SELECT page_id, '/' || regexp_replace(regexp_replace(url, '^[a-zA-Z]+://', ''), '[?#].*$', '') AS path
  FROM pages"""
