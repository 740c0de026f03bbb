"""Upserts into a stored table, incremental snapshots of files."""

import glob
import os

import pytest

from assay.sources import sinks
from assay.sources import snapshots as N
from assay.sources import stored as X


def local(path):
    return path.replace("file:", "")


def files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{local(root)}/data/**/*.parquet", recursive=True)}


def content(spark, root, number=None):
    return {r.k: r.v for r in X.read(spark, root, number).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_upserts(spark):
    root = sinks.new_scratch(spark, "upsert")
    X.create(frame(spark, [(i, "a") for i in range(200)]), root, "k", buckets=16)
    before = files(root)
    assert X.upsert(frame(spark, [(3, "b"), (3, "b"), (1000, "n"), (5, "x"), (5, "y"), (None, "z"), (7, "a")]), root, "k", "overwrite", "one") == {
        "buckets": 2, "inserted": 1, "updated": 1, "conflicts": 2}
    want = {i: "a" for i in range(200)} | {3: "b", 1000: "n"}
    assert content(spark, root) == want
    after = files(root)
    assert before.items() <= after.items() and len(after) == len(before) + 2          # other buckets keep their files
    # The same batch again, whatever it holds now.
    assert X.upsert(frame(spark, [(9, "q")]), root, "k", "overwrite", "one")["buckets"] == 0
    assert content(spark, root) == want and files(root) == after
    assert X.upsert(frame(spark, [(3, "c"), (2000, "m")]), root, "k", "ignore", "two") == {"buckets": 1, "inserted": 1, "updated": 0, "conflicts": 0}
    assert X.upsert(frame(spark, [(4, None), (3000, "m")]), root, "k", "update", "three") == {"buckets": 1, "inserted": 0, "updated": 1, "conflicts": 0}
    assert content(spark, root) == want | {2000: "m", 4: None}
    assert content(spark, root, 0) == {i: "a" for i in range(200)}                      # the manifest of old still holds
    with pytest.raises(ValueError):
        X.upsert(frame(spark, []), root, "k", "replace", "four")


def test_lost_upsert_leaves_the_table_as_it_was(spark):
    root = sinks.new_scratch(spark, "upsert")
    X.create(frame(spark, [(i, "a") for i in range(20)]), root, "k", buckets=4)
    real, X._commit = X._commit, None
    try:
        with pytest.raises(TypeError):
            X.upsert(frame(spark, [(i, "b") for i in range(20)]), root, "k", "overwrite", "one")
    finally:
        X._commit = real
    assert set(content(spark, root).values()) == {"a"}
    X.upsert(frame(spark, [(i, "b") for i in range(20)]), root, "k", "overwrite", "one")
    assert set(content(spark, root).values()) == {"b"}


def test_empty_tables(spark):
    root = sinks.new_scratch(spark, "upsert")
    X.create(frame(spark, []), root, "k", buckets=4)
    assert content(spark, root) == {}
    X.upsert(frame(spark, [(1, "a")]), root, "k", "overwrite", "one")
    X.upsert(frame(spark, []), root, "k", "overwrite", "two")
    assert content(spark, root) == {1: "a"}


def test_second_snapshot_reads_changed_files_only(spark):
    root = sinks.new_scratch(spark, "files")
    tree, state = f"{local(root)}/tree", f"{root}/state"
    os.makedirs(f"{tree}/a/b")

    def put(name, text, at):
        with open(f"{tree}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{tree}/{name}", (at, at))

    for i in range(6):
        put(f"a/f{i}.txt", f"text {i}", 1_700_000_000 + i)
    put("a/b/g.txt", "deep\ntext", 1_700_000_000)
    assert N.take(spark, tree, state) == 0
    # A file that is not read again cannot show what it holds now.
    put("a/f1.txt", "text Z", 1_700_000_001)
    put("a/f2.txt", "new text", 1_700_000_500)
    put("a/h.txt", "é", 1_700_000_600)
    os.remove(f"{tree}/a/b/g.txt")
    assert N.take(spark, tree, state) == 1
    got = {(r.run, r.path, r.version, r.change, r.contents) for r in N.history(spark, state).where("run = 1").collect()}
    assert got == {(1, "/a/f2.txt", 2, "changed", "new text"), (1, "/a/h.txt", 1, "added", "é"), (1, "/a/b/g.txt", 2, "removed", None)}
    now = {r.path: (r.version, r.contents) for r in N.present(spark, state).collect()}
    assert now["/a/f1.txt"] == (1, "text 1") and "/a/b/g.txt" not in now and len(now) == 7
    put("a/b/g.txt", "back", 1_700_000_700)
    N.take(spark, tree, state)
    assert {r.path: r.version for r in N.present(spark, state).collect()}["/a/b/g.txt"] == 3
    assert N.take(spark, tree, state) == 3 and N.history(spark, state).where("run = 3").count() == 0


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    from assay.sources.files import list_files

    for i in range(150):
        (tmp_path / "tree" / f"d{i}").mkdir(parents=True)
        (tmp_path / "tree" / f"d{i}" / "f.txt").write_text("x" * (i + 1))
    sc, name = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    sc.setJobGroup("listing", "listing")
    try:
        listed = list_files(spark, str(tmp_path / "tree"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in sc.statusTracker().getJobIdsForGroup("listing") for s in sc.statusTracker().getJobInfo(j).stageIds]
    assert 0 < sum(sc.statusTracker().getStageInfo(s).numTasks for s in stages) <= max(32, 2 * sc.defaultParallelism) < 150
    assert {(r.path, r.length) for r in listed.collect()} == {(f"/d{i}/f.txt", i + 1) for i in range(150)}
    assert spark.conf.get(name) == before


def recorded_reads(monkeypatch, tree):
    """The number of files of every read of the tree, as they come."""
    from pyspark.sql.readwriter import DataFrameReader

    sizes = []
    for name in ("load", "text"):
        def read(self, path, *args, f=getattr(DataFrameReader, name), **options):
            df = f(self, path, *args, **options)
            if any(tree in p for p in ([path] if isinstance(path, str) else path)):
                sizes.append(len(df.inputFiles()))
            return df
        monkeypatch.setattr(DataFrameReader, name, read)
    return sizes


def test_trees_are_listed_and_read_in_slices(spark, monkeypatch):
    root = sinks.new_scratch(spark, "files")
    tree, state = f"{local(root)}/tree", f"{root}/state"
    names = [f"wide/f{i}.txt" for i in range(25)] + [f"deep/d{i}/e/f{j}.txt" for i in range(8) for j in range(3)] + [
        "odd/a b.txt", "odd/x%20y.txt", "odd/b[1].txt", "odd/[c]/{d,e}.txt", "odd/s*r?.txt", "odd/1+1.txt", "odd/back\\slash.txt", "odd/é.txt", "odd/_k=1/f.txt", "top.txt"]
    for name in [*names, "deep/.hidden.txt", "_left/out.txt", "odd/_out.txt"]:
        os.makedirs(os.path.dirname(f"{tree}/{name}"), exist_ok=True)
        with open(f"{tree}/{name}", "w") as f:
            f.write(f"text of {name}")
    open(f"{tree}/empty.txt", "w").close()
    os.makedirs(f"{tree}/nothing/below")
    monkeypatch.setattr(N, "FILES_AT_ONCE", 7, raising=False)
    sizes = recorded_reads(monkeypatch, tree)
    # What a lost run left is not part of the next.
    frame(spark, [(1, "lost")]).selectExpr("v as path").write.parquet(f"{state}/run=0")
    os.remove(f"{local(state)}/run=0/_SUCCESS")
    assert N.take(spark, tree, state) == 0
    assert max(sizes) <= 7 and sum(sizes) == 2 * len(names) + 1               # the empty file is listed
    got = {r.path: (r.version, r.change, r.contents, r.length) for r in N.history(spark, state).collect()}
    assert got == {f"/{n}": (1, "added", f"text of {n}", len(f"text of {n}".encode())) for n in names}
    sizes.clear()
    with open(f"{tree}/odd/b[1].txt", "w") as f:
        f.write("changed text")
    for i in range(8):
        os.remove(f"{tree}/deep/d{i}/e/f0.txt")
    assert N.take(spark, tree, state) == 1
    assert max(sizes) <= 7 and sum(sizes) == len(names) + 1 - 8 + 1         # listed, and the changed file read
    got = {(r.path, r.version, r.change, r.contents) for r in N.history(spark, state).where("run = 1").collect()}
    assert got == {("/odd/b[1].txt", 2, "changed", "changed text")} | {(f"/deep/d{i}/e/f0.txt", 2, "removed", None) for i in range(8)}
    assert sorted(os.listdir(local(state))) == ["run=0", "run=1"]


def test_files_removed_while_a_snapshot_is_taken(spark, monkeypatch):
    root = sinks.new_scratch(spark, "files")
    tree, state = f"{local(root)}/tree", f"{root}/state"
    os.makedirs(f"{tree}/a")
    for i in range(4):
        with open(f"{tree}/a/f{i}.txt", "w") as f:
            f.write(f"text {i}")
    real = N._read_new

    def later(*args):
        os.remove(f"{tree}/a/f2.txt")
        return real(*args)

    monkeypatch.setattr(N, "_read_new", later)
    assert N.take(spark, tree, state) == 0
    assert {r.path: r.contents for r in N.history(spark, state).collect()} == {f"/a/f{i}.txt": "" if i == 2 else f"text {i}" for i in range(4)}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        N.take(spark, f"{tree}/none", f"{state}-2")
    monkeypatch.setattr(N, "_read_new", real)
    for i in (0, 1, 3):
        os.remove(f"{tree}/a/f{i}.txt")
    assert N.take(spark, tree, state) == 1                                   # an empty tree
    assert N.present(spark, state).count() == 0 and N.known(spark, state).where("change = 'removed'").count() == 4


def test_trees_are_written_in_slices(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.readwriter import DataFrameWriter

    from assay.plans import manifests as P

    root = local(sinks.new_scratch(spark, "tree"))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "s").alias("source"), F.concat(F.lit("text "), "id").alias("text"))
    there, wrote, text = lambda: len(glob.glob(f"{root}/**/*.txt", recursive=True)), [], DataFrameWriter.text

    def write(self, *args, **options):
        before = there()
        text(self, *args, **options)
        wrote.append(there() - before)

    monkeypatch.setattr(P, "FILES_OF_A_JOB", 20, raising=False)
    monkeypatch.setattr(DataFrameWriter, "text", write)
    P._write_tree(docs, root)
    assert sum(wrote) == 80 and max(wrote) <= 40
    back = spark.read.text(root).groupBy("turn", "part", "source").agg(F.count("*").alias("n"), F.min("value").alias("v"))
    got = {(r.turn, r.part, r.source, r.n, r.v) for r in back.collect()}
    assert got == {(p % 3, p, "none" if odd else "s", 50, min(f"text {i}" for i in range(100 * p + odd, 100 * p + 100, 2))) for p in range(40) for odd in (0, 1)}
