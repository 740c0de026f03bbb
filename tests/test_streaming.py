"""Streaming jobs: late rows are counted, and the incremental result equals
its batch twin."""

from pyspark.sql import functions as F

from assay.plans import QUERIES
from assay.sources import sinks
from assay.streaming import jobs as J

from conftest import SMOKE


def test_stream_latest_equals_batch_twin(spark):
    a = QUERIES["stream_latest_scorecard"](spark, SMOKE)
    b = QUERIES["latest_scorecard"](spark, SMOKE)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_late_rows_are_reported(spark, tables):
    import time

    root = sinks.new_scratch(spark, "late")
    ev = tables.events.select("event_id", "ts", "event_type")
    # newest rows first, older rows later (one file per append, written in
    # that order): with one file per trigger the watermark has moved past the
    # old rows when they arrive
    n = ev.count()
    for lo, hi in [(2 * n // 3, n), (n // 3, 2 * n // 3), (0, n // 3)]:
        ev.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.mode("append") \
            .parquet(f"{root}/in")
        time.sleep(1.1)                      # distinct modification times order the files
    s = J.file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = J.windowed_counts(s, "ts", ["event_type"], "1 day", "1 hour", f"{root}/out", f"{root}/ckpt")
    dropped = J.rows_dropped_by_watermark(q)
    kept = spark.read.parquet(f"{root}/out").agg(F.sum("n")).first()[0] or 0
    assert dropped > 0 and kept + dropped <= ev.count()


def test_silent_keys_leave_the_state_and_come_back(spark):
    """Three arrivals against a replay by hand: changes, expiries, late rows."""
    from assay.streaming import expiring as E

    schema = "k string, ts timestamp_ntz, id long, v double"
    day = 86_400_000
    arrivals = [[("a", 1, 1, 1.0), ("a", 1, 2, 2.0), ("b", 2, 3, 3.0), ("c", 10, 4, None)],
                [("d", 20, 5, 5.0), ("a", 12, 6, 6.0), (None, 18, 7, 7.0)],
                [("b", 30, 8, 8.0), ("e", 3, 9, 9.0), ("d", 29, 10, 1.0), ("f", None, 11, 1.0)]]
    root = sinks.new_scratch(spark, "expiring")
    for rows in arrivals:
        text = [(k, None if d is None else f"2024-01-{d:02d} 00:00:00", i, v) for k, d, i, v in rows]
        spark.createDataFrame(text, "k string, ts string, id long, v double").selectExpr("k", "cast(ts as timestamp_ntz) ts", "id", "v") \
            .write.mode("append").parquet(f"{root}/in")
        E.keep_live(J.file_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema), ["k"], "v", "ts", "id", 5 * 86400, "1 hour",
                    f"{root}/out", f"{root}/ckpt")
    rows = sorted(((r.k, r.at_ms // day - 19722, r.v, r.live) for r in E.changes(spark, f"{root}/out").collect()), key=repr)
    # Days of January: a and b expire after the first arrival, a comes back with its
    # row of the 12th and expires after the second, c expires; "e" of the 3rd is too late.
    assert rows == sorted([("a", 1, 2.0, True), ("b", 2, 3.0, True), ("c", 10, None, True), ("a", 1, 2.0, False), ("b", 2, 3.0, False),
                           ("d", 20, 5.0, True), ("a", 12, 6.0, True), (None, 18, 7.0, True), ("a", 12, 6.0, False), ("c", 10, None, False),
                           ("b", 30, 8.0, True), ("d", 29, 1.0, True), (None, 18, 7.0, False)], key=repr)
    live = {r.k: r.v for r in E.read_live(spark, f"{root}/out", ["k"], "v").collect()}
    assert live == {"b": 8.0, "d": 1.0}


def test_replays_do_not_count_in_rolling_windows(spark):
    schema = "id long, ts timestamp_ntz, k string"
    root = sinks.new_scratch(spark, "rolling")
    rows = [(i, f"2024-01-{1 + i % 9:02d} 0{i % 8}:00:00", "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, ts string, k string").selectExpr("id", "cast(ts as timestamp_ntz) ts", "k")
    for _ in range(3):
        df.write.mode("append").parquet(f"{root}/in")
    J.rolling_counts(J.file_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema), "ts", ["id"], ["k"], "2 days", "1 day", "1 day",
                     f"{root}/out", f"{root}/ckpt")
    got = {(r.window_start.day if r.window_start.year == 2024 else 0, r.k): r.n for r in spark.read.parquet(f"{root}/out").collect()}
    want = {}
    for _, ts, k in rows:
        for first in (int(ts[8:10]) - 1, int(ts[8:10])):
            if first + 2 <= 8:                     # the newest row is of the 9th, windows that end by the 8th are closed
                want[first if first else (31 if False else 0), k] = want.get((first, k), 0) + 1
    assert {(d % 31, k): n for (d, k), n in got.items()} == want


def test_a_failing_batch_is_set_aside(spark):
    from assay.streaming import gate as G

    root = sinks.new_scratch(spark, "gate")
    ev = spark.createDataFrame([(i, None if i == 25 else 1.0) for i in range(40)], "id long, v double")
    J.land_ranges(ev, f"{root}/in", "id", 10)
    checks = lambda: {"set": F.count_if(F.col("v").isNull()) == 0, "mean": F.avg("v") == 1.0}
    s = J.file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    G.run_gated(s, checks, f"{root}/out", f"{root}/ckpt", lambda: {"first": F.min("id")})
    G.run_gated(J.file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1), checks, f"{root}/out", f"{root}/ckpt")      # nothing new
    v = {(r.measures["first"], r.check_id): (r.passed, r.batch_passed, r.n_rows) for r in G.verdicts(spark, f"{root}/out").collect()}
    assert v == {(f, c): (c != "set" or f != "20", f != "20", 10) for f in ("0", "10", "20", "30") for c in ("set", "mean")}
    assert sorted(r.id for r in G.quarantine(spark, f"{root}/out").collect()) == list(range(20, 30))
    assert G.passed(spark, f"{root}/out").count() == 30


def batches(monkeypatch, spark):
    """The scratch folders that queries take from now on, and a count of the batches below."""
    import glob

    roots, real = [], sinks.new_scratch
    monkeypatch.setattr(sinks, "new_scratch", lambda spark, name: roots.append(real(spark, name)) or roots[-1])
    return lambda: len(glob.glob(f"{roots[-1].replace('file:', '')}/out/batch_id=*"))


def test_triggers_do_not_follow_the_number_of_files(spark, monkeypatch):
    from assay.plans import streams as S

    monkeypatch.setattr(S, "ROWS_PER_FILE", 40)
    seen = batches(monkeypatch, spark)
    a = QUERIES["stream_latest_scorecard"](spark, SMOKE)
    b = QUERIES["latest_scorecard"](spark, SMOKE)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    assert 1 < seen() <= S.TRIGGERS


def test_scorecards_of_many_ranges_in_one_trigger(spark, monkeypatch):
    from assay.operators import checks as C
    from assay.plans import streams as S

    monkeypatch.setattr(S, "RANGE_WIDTH", 60)
    seen = batches(monkeypatch, spark)
    got = QUERIES["stream_scorecard"](spark, SMOKE)
    ev = spark.read.parquet(f"{SMOKE}/events.parquet")
    top = ev.agg(F.max("event_id")).first()[0]
    want = []
    for b in range(top // 60 + 1):
        one = C.run_suite(ev.where(F.col("event_id").between(60 * b, 60 * b + 59)), S._event_checks(), extra={"batch_first": F.min("event_id")})
        want += one.select(*got.columns).collect()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want)) and top // 60 > S.TRIGGERS
    assert 1 < seen() <= S.TRIGGERS


def test_live_state_is_a_stored_table_of_bounded_size(spark):
    """One file a trigger, five triggers in one run, against a replay by hand; a run without news changes nothing."""
    import glob
    import time

    from assay.streaming import expiring as E

    root = sinks.new_scratch(spark, "expiring")
    arrivals = [[("a", 1, 1, 1.0), ("b", 2, 2, 2.0)], [("c", 9, 3, 3.0)], [("a", 9, 4, 4.0), ("a", 9, 5, None), ("b", 3, 6, 6.0)],
                [("a", 9, 5, 7.0), ("d", 10, 7, 8.0)], [("e", 20, 8, 9.0)]]
    for rows in arrivals:
        spark.createDataFrame([(k, f"2024-01-{d:02d} 00:00:00", i, v) for k, d, i, v in rows], "k string, ts string, id long, v double") \
            .selectExpr("k", "cast(ts as timestamp_ntz) ts", "id", "v").coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(1.1)                      # distinct modification times order the files
    schema = spark.read.parquet(f"{root}/in").schema
    take = lambda: E.keep_live(J.file_stream(spark, f"{root}/in", schema, max_files_per_trigger=1), ["k"], "v", "ts", "id", 5 * 86400, "1 hour",
                               f"{root}/out", f"{root}/ckpt")
    take()
    rows = sorted(((r.batch_id, r.k, r.v, r.live) for r in E.changes(spark, f"{root}/out").collect()), key=repr)
    assert rows == sorted([(0, "a", 1.0, True), (0, "b", 2.0, True), (1, "c", 3.0, True), (1, "a", 1.0, False), (1, "b", 2.0, False),
                           (2, "a", None, True), (3, "d", 8.0, True), (4, "e", 9.0, True), (4, "a", None, False), (4, "c", 3.0, False),
                           (4, "d", 8.0, False)], key=repr)
    take()
    assert {r.k: r.v for r in E.read_live(spark, f"{root}/out", ["k"], "v").collect()} == {"e": 9.0}
    assert len(glob.glob(f"{root.replace('file:', '')}/out-state/batch_id=*")) == 2
