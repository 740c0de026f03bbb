"""Report and tenancy operators on small hand-made frames."""

from pyspark.sql import functions as F

from assay.operators import reports as R
from assay.operators import tenancy as T

col = F.col


def test_cleanup_eligibility(spark):
    jobs = spark.createDataFrame([(1,), (2,), (3,)], "job int")
    runs = spark.createDataFrame([(1, "TERMINATED", "SUCCESS"), (2, "TERMINATED", "FAILED"), (2, "RUNNING", None)],
                                 "job int, lc string, rs string")
    got = {r.job: (r.n_runs, r.eligible) for r in R.cleanup_eligible(jobs, runs, "job", "lc", "rs").collect()}
    assert got == {1: (1, True), 2: (2, False), 3: (0, True)}
    loose = {r.job: r.eligible for r in R.cleanup_eligible(jobs, runs, "job", "lc", "rs", success_only=False).collect()}
    assert loose == {1: True, 2: True, 3: True}


def test_completeness_against_first_user(spark):
    users = spark.createDataFrame([(1,), (2,), (3,), (4,)], "u int")
    files = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "u int")
    got = {r.u: r.status for r in R.completeness(users, files, "u").collect()}
    assert got == {2: "half imported", 3: "extra files found", 4: "missing"}


def test_owners_and_acl(spark):
    acl = spark.createDataFrame([(1, [("a", None, None, [("IS_OWNER", False), ("CAN_VIEW", True)]),
                                      (None, "g", None, [("CAN_RUN", False)])]),
                                 (2, [("a", None, None, [("IS_OWNER", False)]), (None, None, "sp", [("IS_OWNER", False)])])],
                                "o int, access_control_list array<struct<user_name:string,group_name:string,"
                                "service_principal_name:string,all_permissions:array<struct<permission_level:string,"
                                "inherited:boolean>>>>")
    flat = R.flatten_acl(acl, "o")
    assert {(r.o, r.principal_type, r.permission_level) for r in flat.collect()} == {
        (1, "user", "IS_OWNER"), (1, "group", "CAN_RUN"), (2, "user", "IS_OWNER"), (2, "service_principal", "IS_OWNER")}
    own = {r.o: (r.owner, r.ambiguous) for r in R.resolve_owners(flat, acl.select("o"), "o").collect()}
    assert own == {1: ("a", False), 2: (None, True)}


def test_filter_runs_paging(spark):
    runs = spark.range(40).select(F.lit(7).alias("job"), col("id").alias("run"), F.lit("TERMINATED").alias("st"),
                                  F.timestamp_seconds(col("id") * 3600).cast("timestamp_ntz").alias("ts"))
    f = R.filter_runs(runs, job="job", job_id=7, state="st", states=["TERMINATED"], ts="ts", start="1970-01-01 05:00:00",
                      order=[col("ts").desc()], offset=2, limit=3)
    assert [r.run for r in f.collect()] == [37, 36, 35]


def test_contract_codes(spark):
    df = spark.createDataFrame([("abc", 5.0, "1"), (None, 200.0, "x")], "s string, v double, n string")
    got = {(r.column_name, r.error_code): r.violations for r in
           R.column_contract(df, [("s", "string", 3, None, True), ("v", "double", None, 100, True),
                                  ("n", "int", None, None, True)]).collect()}
    assert got == {("s", "Error-Not-None"): 1, ("s", "Error-Min-Len"): 0, ("v", "Error-Not-None"): 0,
                   ("v", "Error-Min-Value"): 1, ("n", "Error-Not-None"): 0, ("n", "Error-Type"): 1}


def test_path_classification(spark):
    df = spark.createDataFrame([(1, "b/lesson"), (2, "includes/Reset"), (3, "a/WIP/x"), (4, "includes/helpers"),
                                (5, "Includes/Workspace-Setup")], "id int, path string")
    got = {r.id: (r.notebook_order, r.test_round, r.include_solution) for r in R.classify_paths(df, "path", "id").collect()}
    # natural order counts every path, WIP ones included, case-sensitively
    assert got == {1: (2, 2, True), 2: (0, 1, False), 4: (4, 0, True), 5: (1, 1, False)}


def test_prefix_matches_and_memberships(spark):
    users = spark.createDataFrame([("ann",), ("bob",)], "u string")
    names = spark.createDataFrame([("ann_x_y",), ("annie_z",)], "n string")
    got = {r.u: r.mode for r in T.prefix_matches(users, "u", col("u"), names, "n").collect()}
    assert got == {"ann": "has_schema", "bob": "missing_schema"}
    people = spark.createDataFrame([("ann", "A"), ("bob", "B")], "u string, seg string")
    want = T.desired_memberships(people, "u", "seg", {"g1": ["A"], "all": ["*"]})
    assert {(r.grp, r.u) for r in want.collect()} == {("g1", "ann"), ("all", "ann"), ("all", "bob")}


def test_upsert_modes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    rows = lambda m: sorted(tuple(r) for r in T.upsert(base, new, m, "k").collect())
    assert rows("overwrite") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows("ignore") == [(1, "a"), (2, "b"), (3, "C")]
    assert rows("update") == [(1, "a"), (2, "B")]
    assert rows("error") == [(2,)]


def test_generate_range_two_levels(spark):
    df = spark.createDataFrame([(1, 25), (2, 0)], "k int, n int")
    got = T.generate_range(df, "k", "n", chunk=7).groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.max("i").alias("m"))
    assert {(r.k, r.c, r.m) for r in got.collect()} == {(1, 26, 25), (2, 1, 0)}
