"""Version selection, dependency status, policy audit and JSON column parsing."""

from pyspark.sql import functions as F

from assay.operators import diff as D
from assay.operators import versions as V
from assay.sources import files as FS

col = F.col


def inventory(spark):
    rows = [("a", "1.2.3"), ("a", "1.10.0"), ("a", "1.9.9"), ("b", "0.0.1")]
    df = spark.createDataFrame(rows, "family string, version string")
    return df.select("family", "version", V.parse(col("version")).alias("p")).select("family", "version", "p.*")


def test_top_two_uses_numeric_order(spark):
    got = {r.family: (r.newest, r.previous) for r in V.top_two(inventory(spark)).collect()}
    assert got == {"a": ("1.10.0", "1.9.9"), "b": ("0.0.1", None)}


def test_select_versions(spark):
    specs = spark.createDataFrame([("a",), ("a:1.2.3",), ("a:9.9.9",), ("zz",)], "spec string")
    got = sorted((r.spec, r.version, r.status) for r in V.select_versions(specs, inventory(spark)).collect())
    assert got == [("a", "1.10.0", "latest"), ("a", "1.9.9", "latest"), ("a:1.2.3", "1.2.3", "pinned"),
                   ("a:9.9.9", "9.9.9", "missing_version"), ("zz", None, "unknown")]


def test_dependency_status(spark):
    tags = spark.createDataFrame([("a", "v1.2.3"), ("a", "v1.10.0"), ("b", "v0.0.1")], "family string, tag string")
    inst = spark.createDataFrame([("a", "1.10.0"), ("b", "main"), ("c", "1.0.0")], "family string, installed string")
    got = {r.family: r.status for r in V.dependency_status(tags, inst).collect()}
    assert got == {"a": "match", "b": "branch", "c": "outdated"}


def test_policy_audit(spark):
    acl = "array<struct<group_name:string,all_permissions:array<struct<permission_level:string>>>>"
    df = spark.createDataFrame([
        ("Student-1", '{"cluster_type": {"value": "all"}, "instance_pool_id": {"value": "p1"}}', [("users", [("CAN_USE",)])]),
        ("Student-2", '{"cluster_type": {"value": "dlt"}}', [("users", [("CAN_VIEW",)])]),
        ("Admin-3", '{"instance_pool_id": {"value": "p0"}}', []),
    ], f"name string, definition string, acl {acl}")
    got = sorted((r.policy, r.error) for r in D.policy_audit(df, "name", "definition", "acl", "p0").collect())
    assert got == [("Student-1", "Wrong instance pool"), ("Student-2", "Missing users access")]


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"n": "a", "k": 1}',), ('{"n": "b", "k": "x"}',), ('{"n": ',)], "j string")
    got = [(r.cfg.n if r.cfg else None, r.corrupt, r.type_error)
           for r in FS.parse_json_column(df, "j", "n string, k int", ["k"]).collect()]
    assert got == [("a", False, False), ("b", False, True), (None, True, False)]
