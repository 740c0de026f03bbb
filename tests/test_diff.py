"""Metamorphic tests for the distributed diffs."""

from pyspark.sql import functions as F

from assay.operators import diff as D


def frame(spark, n=200):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).alias("a"),
                                 F.concat(F.lit("v"), (F.col("id") % 5).cast("string")).alias("b"))


def test_self_diff_is_empty(spark):
    x = frame(spark)
    assert D.multiset_diff(x, x).count() == 0
    assert D.keyed_diff(x, x, ["k"]).count() == 0
    assert D.ordered_diff(x, x, ["k"]).count() == 0
    assert D.frame_summary(D.multiset_diff(x, x)).first().equal


def test_empty_vs_empty_is_equal(spark):
    e = frame(spark).where("false")
    assert D.frame_summary(D.multiset_diff(e, e)).first().equal


def test_multiset_is_permutation_invariant(spark):
    x = frame(spark)
    shuffled = x.orderBy(F.rand(7)).repartition(5)
    assert D.multiset_diff(x, shuffled).count() == 0


def test_multiset_counts_duplicates(spark):
    x = frame(spark, 10)
    doubled = x.unionByName(x.where("k = 3"))
    d = D.multiset_diff(x, doubled).collect()
    assert len(d) == 1 and d[0].side == "right_only" and d[0].n == 1


def test_k_injected_changes_give_k_findings(spark):
    x = frame(spark)
    y = x.withColumn("a", F.when(F.col("k") % 50 == 0, F.col("a") + 1).otherwise(F.col("a")))
    kd = D.keyed_diff(x, y, ["k"]).collect()
    assert len(kd) == 4 and {r.changed_columns for r in kd} == {"a"}
    assert D.multiset_diff(x, y).count() == 8
    assert D.ordered_diff(x, y, ["k"]).count() == 4


def test_rows_equal_ignores_column_order_and_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 5, "y")], "k int, v int, s string")
    b = spark.createDataFrame([("x", None, 1), ("z", 5, 2)], "s string, v int, k int")
    got = {r.k: r.rows_equal for r in D.rows_equal(a, b, ["k"]).collect()}
    assert got == {1: True, 2: False}


def test_snapshot_and_tree_diffs(spark):
    a = spark.createDataFrame([("/a", "x" * 1500), ("/b", "same"), ("/c", "gone")], "path string, contents string")
    b = spark.createDataFrame([("/a", "y" * 12), ("/b", "same"), ("/d", "new")], "path string, contents string")
    got = {r.path: r.message for r in D.snapshot_diff(a, b).collect()}
    assert got["/c"] == "Notebook deleted: `/c`" and got["/d"] == "Notebook added: `/d`"
    label = "1,500 vs 12:"
    assert got["/a"] == f"Differences: {label:>20} /a"
    s = spark.createDataFrame([("/x", "NOTEBOOK", "PYTHON"), ("/y", "NOTEBOOK", "SQL")],
                              "path string, object_type string, language string")
    t = spark.createDataFrame([("/y", "NOTEBOOK", "PYTHON"), ("/z", "DIRECTORY", None)],
                              "path string, object_type string, language string")
    kinds = {r.path: r.kind for r in D.tree_compare(s, t).collect()}
    assert kinds == {"/x": "source_only", "/y": "mismatch", "/z": "target_only"}


def test_spec_drift(spark):
    recs = spark.createDataFrame([(1, "Brand#2", 11), (2, "Brand#3", None)], "id int, p_brand string, p_size int")
    got = {r.id: r.error for r in D.spec_drift(recs, {"p_brand": "Brand#2", "p_size": 11, "p_x": 1}, ["id"]).collect()}
    assert got == {1: "p_x=None", 2: "p_brand=Brand#3, p_size=None, p_x=None"}


def test_diffs_accept_map_and_array_columns(spark):
    a = spark.createDataFrame([(1, [1, 2], {"a": 1, "b": 2}), (2, [3], {"b": 2})], "k int, arr array<int>, m map<string,int>")
    b = spark.createDataFrame([(1, [1, 2], {"b": 2, "a": 1}), (2, [3], {"b": 3})], "k int, arr array<int>, m map<string,int>")
    assert [(r.k, r.changed_columns) for r in D.keyed_diff(a, b, ["k"]).collect()] == [(2, "m")]
    assert {r.k: r.rows_equal for r in D.rows_equal(a, b, ["k"]).collect()} == {1: True, 2: False}
    assert D.multiset_diff(a, b).count() == 2


def test_self_diff_is_empty_with_null_and_repeated_keys(spark):
    x = spark.createDataFrame([(None, 1), (None, None), (1, 2), (1, 2), (1, None), (2, 3)], "k int, v int")
    assert D.multiset_diff(x, x).count() == 0
    assert D.keyed_diff(x, x, ["k"]).count() == 0
    assert all(r.rows_equal for r in D.rows_equal(x, x, ["k"]).collect())


def test_repeated_keys_are_compared_as_multisets(spark):
    a = spark.createDataFrame([(None, 1, "x"), (1, 1, "x"), (1, 2, "y"), (2, 1, "x"), (2, 1, "x"), (3, 1, "x")], "k int, v int, s string")
    b = spark.createDataFrame([(None, 2, "x"), (1, 1, "y"), (1, 2, "x"), (2, 1, "x"), (4, 1, "x")], "k int, v int, s string")
    got = {r.k: (r.kind, r.changed_columns) for r in D.keyed_diff(a, b, ["k"]).collect()}
    assert got == {None: ("changed", "v"), 1: ("changed", ""), 2: ("changed", "v,s"), 3: ("left_only", None), 4: ("right_only", None)}
    assert {r.k: r.rows_equal for r in D.rows_equal(a, b, ["k"]).collect()} == dict.fromkeys([None, 1, 2, 3, 4], False)


def test_columns_of_one_side_are_reported_in_all_modes(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(1, 2, None)], "k int, v int, z string")
    for x, y, side in ((a, b, "right_only"), (b, a, "left_only")):
        assert {r.side for r in D.multiset_diff(x, y).collect()} == {"left_only", "right_only", f"{side} column z"}
        assert [(r.k, r.kind, r.changed_columns) for r in D.keyed_diff(x, y, ["k"]).collect()] == [(None, f"column_{side}", "z")]
        assert [(r.kind, r.changed_columns) for r in D.ordered_diff(x, y, ["k"]).collect()] == [(f"column_{side}", "z")]
        assert [r.rows_equal for r in D.rows_equal(x, y, ["k"]).collect()] == [False]
        assert D.multiset_diff(x.where("false"), y.where("false")).count() == 1


def test_types_compare_by_value(spark):
    a, b = spark.createDataFrame([(1, 2, 1.5)], "k int, v int, d double"), spark.createDataFrame([(1, 2.0, "1.5")], "k bigint, v double, d string")
    assert [(r.kind, r.changed_columns) for r in D.keyed_diff(a, b, ["k"]).collect()] == [("changed", "d")]
    assert [(r.kind, r.changed_columns) for r in D.ordered_diff(a, b, ["k"]).collect()] == [("changed", "d")]


def test_policy_audit_with_entries_of_users(spark):
    rows = [("Student-1", "{}", [(None, [("CAN_USE",)])]), ("Student-2", "{}", [(None, [("X",)]), ("users", [("CAN_USE",)])]), ("Student-3", "{}", None),
            ("Student-4", "{}", []), ("Admin-1", "{}", None)]
    df = spark.createDataFrame(rows, "name string, definition string, acl array<struct<group_name:string,all_permissions:array<struct<permission_level:string>>>>")
    got = sorted((r.policy, r.error) for r in D.policy_audit(df, "name", "definition", "acl", "p").collect())
    assert [p for p, e in got if e == "Missing users access"] == ["Student-1", "Student-3", "Student-4"]
    assert len([p for p, e in got if e == "Wrong instance pool"]) == 5
