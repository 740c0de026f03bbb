"""Inputs beyond bounds that once cut or dropped something."""

from pyspark.sql import functions as F

from assay.functions import names as N
from assay.functions.text import left_pad, tail
from assay.operators import reports as R
from assay.operators import tenancy as T
from assay.operators import versions as V
from assay.operators.graph import propagate_skips, reached


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_long_lesson_numbers(spark):
    assert one(spark, N.lesson_number(F.lit("2024010112 - Intro"))) == 2024010112
    assert one(spark, N.lesson_number(F.lit("9" * 18 + " - Intro"))) == int("9" * 18)


def test_padding_does_not_cut(spark):
    assert one(spark, left_pad(F.lit("123456789"), 8, "0")) == "123456789"
    assert one(spark, left_pad(F.lit("1"), 3, "0")) == "001"
    assert one(spark, N.zero_pad(F.lit(12345678901).cast("bigint"), 9)) == "12345678901"


def test_tail_is_the_whole_rest(spark):
    n = (1 << 20) + 100
    assert one(spark, F.length(tail(F.repeat(F.lit("é"), n), 3))) == n - 2
    assert one(spark, tail(F.lit("abc"), 9)) == ""


def test_large_version_parts(spark):
    df = spark.createDataFrame([("4000000000.0.1",), ("9.9.9",)], "version string")
    rows = df.select("version", V.parse(F.col("version")).alias("p")).select("version", "p.*")
    assert [r.version for r in V.order(rows, ["version"]).orderBy("position").collect()] == ["9.9.9", "4000000000.0.1"]


def test_deep_chain_and_cycle(spark):
    n = 120
    nodes = spark.createDataFrame([(i, i != 0) for i in range(n)] + [(1000 + i, i != 0) for i in range(3)], "id int, ok boolean")
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, n)] + [(1000, 1002), (1001, 1000), (1002, 1001)], "child int, parent int")
    got = {r.id: r.status for r in propagate_skips(nodes, edges).collect()}
    assert got[0] == "failed" and {got[i] for i in range(1, n)} == {"skipped"}
    assert [got[1000 + i] for i in range(3)] == ["skipped"] * 3


def frames(spark, ok, edges):
    return (spark.createDataFrame(list(ok.items()), "id int, ok boolean"), spark.createDataFrame(edges, "child int, parent int"))


def test_chain_of_ten_thousand_in_few_rounds(spark):
    n = 10_000
    nodes, edges = frames(spark, {i: i != 0 for i in range(n + 1)}, [(i, i - 1) for i in range(1, n + 1)])
    found, rounds = reached(edges, nodes.where("not ok"))
    assert found.count() == n and rounds <= 15


def test_unsettled_chains_and_long_cycles_end(spark):
    n = 3000
    nodes, edges = frames(spark, {i: True for i in range(n)} | {n: False}, [(i, (i + 1) % n) for i in range(n)] + [(n, 5)])
    found, rounds = reached(edges, nodes.where("not ok"))
    assert found.count() == 0 and rounds <= 15
    nodes, edges = frames(spark, {0: False, 1: True}, [(1, 0), (1, 0), (1, 1), (0, 0), (None, 0), (1, None)])
    assert {r.id: r.status for r in propagate_skips(nodes, edges).collect()} == {0: "skipped", 1: "skipped"}


def test_braided_graphs_do_not_outgrow_their_edges(spark, monkeypatch):
    """Layers that depend on all of the layer before: doubled pointers would
    stay few, pointers over ranges would not; both are settled."""
    import random

    rng = random.Random(2)
    layers, width = 60, 6
    braid = [(a * width + i, (a - 1) * width + j) for a in range(1, layers) for i in range(width) for j in range(width)]
    span = [(i, i - d) for i in range(1, 400) for d in range(1, min(i, 12) + 1)]
    for edges in (braid, span, braid[::3] + [(c + 1000, p + 1000) for c, p in span[::5]]):
        ids = {x for e in edges for x in e}
        ok = {i: rng.random() > 0.02 for i in ids}
        parents = {}
        for c, p in edges:
            parents.setdefault(c, []).append(p)
        bad = set()
        for i in sorted(ids):
            if any(not ok[p] or p in bad for p in parents.get(i, ())):
                bad.add(i)
        for few in (100_000, 0):
            monkeypatch.setattr("assay.operators.graph.FEW", few)
            nodes, e = frames(spark, ok, edges)
            got = {r.id for r in propagate_skips(nodes, e).where("status = 'skipped'").collect()}
            assert got == bad


def test_permissions_without_the_inherited_flag(spark):
    acl = "array<struct<user_name:string,group_name:string,service_principal_name:string,all_permissions:array<struct<permission_level:string,inherited:boolean>>>>"
    df = spark.createDataFrame([(1, [("u", "g", None, [("IS_OWNER", None), ("X", True)]), (None, None, "s", None), (None, None, "s", [("Y", False)])])], f"o int, access_control_list {acl}")
    got = sorted(tuple(r)[1:] for r in R.flatten_acl(df, "o").collect())
    assert got == [("group", "g", "IS_OWNER"), ("service_principal", "s", "Y"), ("user", "u", "IS_OWNER")]


def test_users_without_groups(spark):
    df = spark.createDataFrame([(1, [("e",)], None), (2, [("e",)], [(None,)]), (3, [("e",)], [("admins",)]), (4, None, None), (5, [(None,)], [])],
                               "id int, entitlements array<struct<value:string>>, groups array<struct<display:string>>")
    assert sorted(r.id for r in R.holders_outside(df, "e", "admins").collect()) == [1, 2]


def test_names_without_a_separator_match_nothing(spark):
    users = spark.createDataFrame([("foo",), ("bar",)], "u string")
    names = spark.createDataFrame([("foo",), ("bar_x",)], "n string")
    got = {r.u: r.mode for r in T.prefix_matches(users, "u", F.col("u"), names, "n").collect()}
    assert got == {"foo": "missing_schema", "bar": "has_schema"}
