"""Streaming re-aims (rows 82-85): the result bookkeeping of the check suite
and the run log as Structured Streaming jobs over the events table landed
as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import checks as C
from assay.plans.registry import query
from assay.sources import sinks
from assay.streaming import expiring as E
from assay.streaming import gate as G
from assay.streaming import jobs as J

col = F.col
ROWS_PER_FILE = 100_000      # of a landed file, and event ids of a range; the number of files follows the table
TRIGGERS = 12                # that take all landed files, one file each while there are no more


def _landed(t, name):
    spark = t.spark
    root = sinks.new_scratch(spark, name)
    ev = t.events
    J.land_files(ev, f"{root}/in", ROWS_PER_FILE)
    return spark, root, ev.schema


@query("stream_latest_scorecard", """
WITH r AS (SELECT user_id, event_type, ts, event_id, event_type <> 'error' AS ok FROM events),
l AS (SELECT user_id, event_type, arg_max_null(ok, (ts, event_id)) AS ok FROM r GROUP BY user_id, event_type)
SELECT user_id, CAST(count(*) AS BIGINT) AS n_checks, CAST(count_if(ok) AS BIGINT) AS score,
  CAST(count(*) AS BIGINT) AS max_score,
  CAST(floor(100.0 * count_if(ok) / count(*)) AS INTEGER) AS percentage,
  floor(100.0 * count_if(ok) / count(*)) = 100 AS passed
FROM l GROUP BY user_id""")
def stream_latest_scorecard(t):
    """Rows 82, 83: last result per check (user x event type) kept as streaming
    state over files arriving in up to a dozen triggers; the final state equals
    the batch result whatever the file order, so the batch oracle applies."""
    spark, root, schema = _landed(t, "stream-latest")
    s = J.file_stream(spark, f"{root}/in", schema, J.files_per_trigger(spark, f"{root}/in", schema, TRIGGERS))
    s = s.select("user_id", "event_type", "ts", "event_id", (col("event_type") != "error").alias("ok"))
    J.latest_per_key(s, ["user_id", "event_type"], "ok", ["ts", "event_id"], f"{root}/out",
                     J.checkpoint_location(root, "ckpt/latest"))
    latest = J.read_latest(spark, f"{root}/out", ["user_id", "event_type"], "ok")
    g = latest.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_checks"), F.count_if("ok").alias("score"))
    pct = F.floor(F.lit(100.0) * col("score") / col("n_checks")).cast("int")
    return g.select("user_id", "n_checks", "score", col("n_checks").alias("max_score"), pct.alias("percentage"),
                    (pct == 100).alias("passed"))


@query("stream_run_health", """
WITH r AS (SELECT ts, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'signup' THEN 'IGNORED' ELSE 'SUCCESS' END AS result_state FROM events),
w AS (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, result_state FROM r)
SELECT window_start, window_end, result_state, CAST(count(*) AS BIGINT) AS n FROM w
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY ALL""")
def stream_run_health(t):
    """Rows 82, 84: pass/fail counts of the run log per day window behind a
    one-day watermark (append mode: closed windows only).  All files are
    read in one available-now batch, so no row is late and the closed
    windows equal the batch counts of windows ending before max(ts) - 1 day."""
    spark, root, schema = _landed(t, "stream-health")
    s = J.file_stream(spark, f"{root}/in", schema)
    s = s.select("ts", F.when(col("event_type") == "error", "FAILED").when(col("event_type") == "signup", "IGNORED")
                 .otherwise("SUCCESS").alias("result_state"))
    J.windowed_counts(s, "ts", ["result_state"], "1 day", "1 day", f"{root}/out",
                      J.checkpoint_location(root, "ckpt/health"))
    r = spark.read.parquet(f"{root}/out")
    return r.select(J.utc_wall_clock(col("window_start")).alias("window_start"),
                    J.utc_wall_clock(col("window_end")).alias("window_end"), "result_state", "n")


SILENT_DAYS = 5      # until a key leaves the state; its watermark stands an hour behind


@query("stream_live_results", f"""
WITH l AS (SELECT user_id, event_type, max(ts) AS last_ts, arg_max_null(value, (ts, event_id)) AS value FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, value FROM l
WHERE epoch_ms(last_ts) + {SILENT_DAYS} * 86400000 >= (SELECT epoch_ms(max(ts)) - 3600000 FROM events)""")
def stream_live_results(t):
    """Row 83: the last result per key as state that forgets keys silent for
    five days.  The table arrives in three parts by time, each taken by a run
    that resumes from the checkpoint; keys expire between and come back."""
    spark = t.spark
    root = sinks.new_scratch(spark, "stream-live")
    ev = t.events.where("ts is not null")
    at = F.unix_micros(J.event_time(ev, "ts"))
    cut = ev.agg(F.percentile_approx(at, F.array(F.lit(0.33), F.lit(0.67))).alias("c")).first().c
    bounds = [at > c for c in cut] if cut else []
    parts = [~bounds[0], bounds[0] & ~bounds[1], bounds[1]] if bounds else [F.lit(True)]
    keys = ["user_id", "event_type"]
    for part in parts:
        ev.where(part).write.mode("append").parquet(f"{root}/in")
        E.keep_live(J.file_stream(spark, f"{root}/in", ev.schema), keys, "value", "ts", "event_id", SILENT_DAYS * 86400, "1 hour",
                    f"{root}/out", J.checkpoint_location(root, "ckpt/live"))
    return E.read_live(spark, f"{root}/out", keys, "value")


def _event_checks():
    return [
        C.check_not_none("user_set", col("user_id")),
        C.check_contains("known_type", col("event_type"), ["signup", "purchase", "error", "view", "click"]),
        C.check_true("value_positive", col("value") > 0),
        C.check_floats("mean_value", F.avg("value"), 25.0, tolerance=5.0),
        C.check_false("no_errors", col("event_type") == "error"),
        C.check_true("json_props", F.get_json_object("props", "$.k").isNotNull()),
    ]


def _land_ranges(t, name):
    """events landed as one file per range of event ids, in one pass."""
    spark = t.spark
    root = sinks.new_scratch(spark, name)
    ev = t.events
    J.land_ranges(ev, f"{root}/in", "event_id", RANGE_WIDTH)
    return spark, root, ev.schema


RANGE_WIDTH = 25_000

_BATCH_SQL = f"""
WITH e AS (SELECT *, CAST(event_id // {RANGE_WIDTH} AS BIGINT) AS b FROM events),
a AS (SELECT b, min(event_id) AS batch_first,
        count_if(user_id IS NULL) = 0 AS ok1,
        count_if(NOT coalesce(event_type IN ('signup','purchase','error','view','click'), false)) = 0 AS ok2,
        coalesce(bool_and(coalesce(value > 0, false)), true) AS ok3,
        coalesce(abs(avg(value) - 25.0) <= 5.0, false) AS ok4,
        coalesce(bool_and(coalesce(NOT (event_type = 'error'), false)), true) AS ok5,
        coalesce(bool_and(coalesce(json_extract_string(props, '$.k') IS NOT NULL, false)), true) AS ok6
      FROM e GROUP BY b),
u AS (SELECT batch_first, seq, check_id, ok FROM a, (VALUES (1, 'user_set'), (2, 'known_type'), (3, 'value_positive'),
        (4, 'mean_value'), (5, 'no_errors'), (6, 'json_props')) v(seq, check_id),
        LATERAL (SELECT CASE seq WHEN 1 THEN ok1 WHEN 2 THEN ok2 WHEN 3 THEN ok3 WHEN 4 THEN ok4 WHEN 5 THEN ok5 ELSE ok6 END AS ok)),
w AS (SELECT *, coalesce(bool_or(NOT ok) OVER (PARTITION BY batch_first ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS skipped FROM u),
st AS (SELECT batch_first, CAST(seq AS INTEGER) AS seq, check_id,
         CASE WHEN skipped THEN 'skipped' WHEN ok THEN 'passed' ELSE 'failed' END AS status,
         CAST(CASE WHEN NOT skipped AND ok THEN 1 ELSE 0 END AS INTEGER) AS points FROM w)
SELECT st.*, CAST(sum(points) OVER (PARTITION BY batch_first) AS BIGINT) AS score, CAST(6 AS BIGINT) AS max_score,
  CAST(floor(100.0 * sum(points) OVER (PARTITION BY batch_first) / 6) AS INTEGER) AS percentage
FROM st"""


@query("stream_scorecard", _BATCH_SQL)
def stream_scorecard(t):
    """Rows 82, 85: the event constraints evaluated on every file of every
    micro-batch (up to a dozen) with foreachBatch; the scorecards of a batch are
    written under its batch id (idempotent on replay), each identified by its
    first event.  A file holds one range of event ids, so the rows of a scorecard
    are known whatever order the files are picked in."""
    spark, root, schema = _land_ranges(t, "stream-score")
    s = J.file_stream(spark, f"{root}/in", schema, J.files_per_trigger(spark, f"{root}/in", schema, TRIGGERS))
    J.batch_scorecards(s, _event_checks, f"{root}/out", J.checkpoint_location(root, "ckpt/score"), "event_id", RANGE_WIDTH)
    r = spark.read.parquet(f"{root}/out")
    return r.select("batch_first", "seq", "check_id", "status", "points", "score", "max_score", "percentage")


@query("stream_rolling_health", """
WITH r AS (SELECT ts, CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type = 'signup' THEN 'IGNORED' ELSE 'SUCCESS' END AS result_state
           FROM events WHERE ts IS NOT NULL),
w AS (SELECT date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS window_start, result_state FROM r, range(3) t(k))
SELECT window_start, window_start + INTERVAL 3 DAY AS window_end, result_state, CAST(count(*) AS BIGINT) AS n FROM w
WHERE window_start + INTERVAL 3 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY ALL""")
def stream_rolling_health(t):
    """Row 84, rolling: counts of the last three days, day by day, while every
    event arrives twice; a replayed event counts once."""
    spark = t.spark
    root = sinks.new_scratch(spark, "stream-rolling")
    ev = t.events.where("ts is not null")
    for _ in range(2):
        ev.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{root}/in")
    s = J.file_stream(spark, f"{root}/in", ev.schema)
    s = s.select("event_id", "ts", F.when(col("event_type") == "error", "FAILED").when(col("event_type") == "signup", "IGNORED")
                 .otherwise("SUCCESS").alias("result_state"))
    J.rolling_counts(s, "ts", ["event_id"], ["result_state"], "3 days", "1 day", "1 day", f"{root}/out", J.checkpoint_location(root, "ckpt/rolling"))
    r = spark.read.schema("window_start timestamp, window_end timestamp, result_state string, n bigint").parquet(f"{root}/out")
    return r.select(J.utc_wall_clock(col("window_start")).alias("window_start"), J.utc_wall_clock(col("window_end")).alias("window_end"), "result_state", "n")


BATCHES = 6      # that the gated stream arrives in


def _gate_checks():
    return {"user_set": F.count_if(col("user_id").isNull()) == 0,
            "few_errors": F.count_if(col("event_type") == "error") * 10 <= F.count(F.lit(1)) * 2,
            "mean_value": F.abs(F.avg("value") - 25.0) <= 0.6}


@query("stream_gated", f"""
WITH e AS (SELECT *, event_id // (SELECT max(event_id) // {BATCHES} + 1 FROM events) AS b FROM events),
a AS (SELECT b, min(event_id) AS batch_first, CAST(count(*) AS BIGINT) AS n_rows, count_if(user_id IS NULL) = 0 AS ok1,
        count_if(event_type = 'error') * 10 <= count(*) * 2 AS ok2, coalesce(abs(avg(value) - 25.0) <= 0.6, false) AS ok3 FROM e GROUP BY b),
v AS (SELECT batch_first, n_rows, check_id, CASE k WHEN 1 THEN ok1 WHEN 2 THEN ok2 ELSE ok3 END AS passed, ok1 AND ok2 AND ok3 AS batch_passed
      FROM a, (VALUES (1, 'user_set'), (2, 'few_errors'), (3, 'mean_value')) c(k, check_id))
SELECT *, CASE WHEN batch_passed THEN n_rows ELSE 0 END AS n_let_in, CASE WHEN batch_passed THEN 0 ELSE n_rows END AS n_set_aside FROM v""")
def stream_gated(t):
    """Row 85, with ``observe``: constraints are metrics of the write of each
    micro-batch, a failing batch goes to quarantine.  The rows let in and set
    aside are counted from what the readers of each side see."""
    spark = t.spark
    root = sinks.new_scratch(spark, "stream-gated")
    ev = t.events
    width = ev.agg(F.max("event_id")).first()[0]
    width = (width or 0) // BATCHES + 1
    J.land_ranges(ev, f"{root}/in", "event_id", width)
    s = J.file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    G.run_gated(s, _gate_checks, f"{root}/out", J.checkpoint_location(root, "ckpt/gate"), lambda: {"batch_first": F.min("event_id")})
    v = G.verdicts(spark, f"{root}/out").withColumn("batch_first", col("measures")["batch_first"].cast("bigint"))
    number = lambda frame, name: frame.groupBy(F.floor(col("event_id") / width).alias("_b")).agg(F.count(F.lit(1)).alias(name))
    v = v.withColumn("_b", F.floor(col("batch_first") / width))
    v = v.join(number(G.passed(spark, f"{root}/out"), "n_let_in"), "_b", "left").join(number(G.quarantine(spark, f"{root}/out"), "n_set_aside"), "_b", "left")
    return v.select("batch_first", "n_rows", "check_id", "passed", "batch_passed", F.coalesce("n_let_in", F.lit(0)).alias("n_let_in"),
                    F.coalesce("n_set_aside", F.lit(0)).alias("n_set_aside"))
