"""Content reconcile against the sequential repair, and what it joins."""

import random

from assay.operators import merkle as K
from test_manifest import sequential, tree, with_dirs

SCHEMA = "path string, size bigint, digest string"


def frame(spark, files):
    return spark.createDataFrame([(p, len(c), c) for p, c in files.items()], SCHEMA)


def found(spark, local, remote, **kw):
    return {(r.action, r.path) for r in K.reconcile_contents(frame(spark, local), frame(spark, remote), **kw).collect()}


def want(local, remote):
    acts = sequential(with_dirs(set(local)), with_dirs(set(remote)))
    return acts | {("replace_file", p) for p in local if p in remote and local[p] != remote[p]}


def test_matches_sequential_repair(spark):
    rng = random.Random(7)
    for trial in range(8):
        base = tree(rng, 60)
        local = {p: "old" if rng.random() < 0.2 else "same" for p in base if rng.random() > 0.15}
        remote = {p: "same" for p in base if rng.random() > 0.15} | {p + "/new": "n" for p in base if rng.random() < 0.05}
        assert found(spark, local, remote) == want(local, remote), trial


def test_empty_sides_roots_and_sizes(spark):
    some = {"/a": "1", "/b/c": "2", "/b/d/e": "3"}
    for local, remote in [(some, {}), ({}, some), ({}, {}), (some, some), ({"/a": "1"}, {"/a": "2"}), ({"/a": "1"}, {"/b/a": "1"})]:
        assert found(spark, local, remote) == want(local, remote)
    assert found(spark, {"/a": "xy"}, {"/a": "yx"}, by="size") == set()
    assert found(spark, {"/a": "xy"}, {"/a": "yxz"}, by="size") == {("replace_file", "/a")}


def test_rows_joined_follow_the_differences(spark):
    files = {f"/d{i % 40}/s{i % 7}/f{i}": "same" for i in range(8000)} | {f"/big/f{i}": "same" for i in range(8000)}
    for changed in ([], ["/d3/s1/f43"], ["/big/f9", "/d3/s1/f43", "/d0/s0/f0"]):
        local, remote = (K.with_directory(frame(spark, x)) for x in (files | {p: "old" for p in changed}, files))
        odd = K._unequal(K.directory_digests(local).select("dir", "h1", "h2", "n"), K.directory_digests(remote).select("dir", "h1", "h2", "n"), ["dir"])
        a, b = K.candidates(local, remote, odd)
        met = a.count() + b.count()
        assert met >= 2 * len(changed) and met <= 60 * len(changed)
    assert found(spark, files | {"/big/f9": "old"}, files) == {("replace_file", "/big/f9")}


def test_nulls(spark):
    a = spark.createDataFrame([("/x", None, None), ("/y", 1, None)], SCHEMA)
    b = spark.createDataFrame([("/x", None, None), ("/y", 1, "d")], SCHEMA)
    assert [(r.action, r.path) for r in K.reconcile_contents(a, b).collect()] == [("replace_file", "/y")]
