"""Reconcile plan vs a brute-force replay of the sequential repair passes."""

import random

from assay.operators import manifest as M


def sequential(local, remote):
    """The four ordered passes of the reference repair, on sorted lists."""
    repaired, actions = [], set()
    local, remote = sorted(local), sorted(remote)

    def free(p):
        return not any(p.startswith(r) for r in repaired)

    for f in local:
        if f not in remote and f.endswith("/") and free(f):
            actions.add(("remove_dir", f))
            repaired.append(f)
    for f in remote:
        if f not in local and f.endswith("/") and free(f):
            actions.add(("restore_dir", f))
            repaired.append(f)
    for f in local:
        if f not in remote and not f.endswith("/") and free(f):
            actions.add(("remove_file", f))
    for f in remote:
        if f not in local and not f.endswith("/") and free(f):
            actions.add(("restore_file", f))
    return actions


def tree(rng, n_files):
    files = set()
    for _ in range(n_files):
        depth = rng.randint(1, 4)
        files.add("/" + "/".join(f"d{rng.randint(0, 3)}" for _ in range(depth - 1)) + f"/f{rng.randint(0, 9)}")
    return files


def with_dirs(files):
    out = set(files)
    for f in files:
        parts = f.split("/")
        for i in range(2, len(parts)):
            out.add("/".join(parts[:i]) + "/")
    return out


def test_reconcile_matches_sequential_repair(spark):
    rng = random.Random(42)
    for trial in range(6):
        base = tree(rng, 40)
        local = {f for f in base if rng.random() > 0.15} | {f + "x" for f in base if rng.random() < 0.1}
        remote = {f for f in base if rng.random() > 0.15}
        lo, re_ = with_dirs(local), with_dirs(remote)
        want = sequential(lo, re_)
        ldf = spark.createDataFrame([(p, p.endswith("/")) for p in lo], "path string, is_dir boolean")
        rdf = spark.createDataFrame([(p, p.endswith("/")) for p in re_], "path string, is_dir boolean")
        got = {(r.action, r.path) for r in M.reconcile(ldf, rdf).collect()}
        assert got == want, trial


def test_manifest_from_files_adds_every_ancestor(spark):
    f = spark.createDataFrame([("/a/b/c.txt",), ("/a/d",)], "path string")
    got = {(r.path, r.is_dir) for r in M.manifest_from_files(f).collect()}
    assert got == {("/a/b/c.txt", False), ("/a/d", False), ("/a/", True), ("/a/b/", True)}


def test_identical_manifests_need_no_fix(spark):
    f = spark.createDataFrame([("/a/b/c.txt",), ("/a/d",)], "path string")
    m = M.manifest_from_files(f)
    v = M.reconcile_verdict(M.reconcile(m, m)).first()
    assert v.fixes == 0 and v.valid
