"""Reconciling the contents of two file trees by directory digests.

A directory's digest covers all files below it: their paths, sizes and content
digests.  Files are summed up by directory first (one aggregation with partial
sums), directories then into all directories above them, so files move once and
only the far fewer directories are multiplied by their depth.  Sums are two
64-bit XORs of hashes and a count: they need no order and no list, however many
files a directory holds.

Directories with equal digests on both sides are equal with all below them and
take no further part.  In the others the files are compared by bucket of names
first, where a bucket is again a digest, and only the files of unequal buckets
meet in the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.manifest import strict_ancestor_dirs

# Action names in pass order.
ACTIONS = ["remove_dir", "restore_dir", "remove_file", "restore_file", "replace_file"]
#: Buckets of the names of a directory.
BUCKETS = 1024


def _sums(*columns: str) -> list[Column]:
    """Order-free digest of rows: two XORs of hashes and the number of rows."""
    return [F.bit_xor(F.xxhash64(F.lit(17), *columns)).alias("h1"), F.bit_xor(F.xxhash64(*columns, F.lit(71))).alias("h2"),
            F.count(F.lit(1)).alias("n")]


def with_directory(files: DataFrame, by: str = "digest") -> DataFrame:
    """``path, dir, mark``: ``dir`` ends in '/', ``mark`` is what is compared of a
    file, its size and digest or (``by="size"``) its size."""
    mark = F.xxhash64("size") if by == "size" else F.concat_ws(":", F.col("size").cast("string"), "digest")
    return files.select("path", F.regexp_replace("path", "[^/]*$", "").alias("dir"), mark.cast("string").alias("mark"))


def directory_digests(files: DataFrame) -> DataFrame:
    """``dir, parent, h1, h2, n`` of every directory that has a file below it
    (``files`` as of :func:`with_directory`); the root is '/', its parent null."""
    own = files.groupBy("dir").agg(*_sums("path", "mark"))
    up = F.concat(strict_ancestor_dirs(F.col("dir")), F.array("dir"), F.when(F.col("dir") != "/", F.array(F.lit("/"))).otherwise(F.array().cast("array<string>")))
    spread = own.select(F.explode(F.array_distinct(up)).alias("at"), "dir", "h1", "h2", "n")
    total = spread.groupBy("at").agg(*_sums("dir", "h1", "h2", "n")[:2], F.sum("n").alias("n"))
    parent = F.when(F.col("at") != "/", F.regexp_replace("at", "[^/]+/$", ""))
    return total.select(F.col("at").alias("dir"), parent.alias("parent"), "h1", "h2", "n")


def _unequal(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, in_a, in_b`` of the digests that are not the same on both sides."""
    a = a.select(*keys, F.struct("h1", "h2", "n").alias("a"))
    b = b.select(*keys, F.struct("h1", "h2", "n").alias("b"))
    return a.join(b, keys, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(
        *keys, F.col("a").isNotNull().alias("in_a"), F.col("b").isNotNull().alias("in_b"))


def candidates(local: DataFrame, remote: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The files of either side that meet in the join: those of unequal buckets
    of the directories of ``changed`` that both sides have."""
    both = changed.where("in_a and in_b").select("dir")
    bucket = F.pmod(F.xxhash64("path"), F.lit(BUCKETS)).alias("bucket")
    lo, re = (x.join(both, "dir", "left_semi").select("*", bucket) for x in (local, remote))
    sums = [x.groupBy("dir", "bucket").agg(*_sums("path", "mark")) for x in (lo, re)]
    odd = _unequal(*sums, ["dir", "bucket"]).select("dir", "bucket")
    return tuple(x.join(odd, ["dir", "bucket"], "left_semi").select("path", "dir", "mark") for x in (lo, re))


def reconcile_contents(local: DataFrame, remote: DataFrame, by: str = "digest") -> DataFrame:
    """``path, is_dir, action, pass_no``: what makes ``local`` equal ``remote``,
    both ``path, size, digest`` with paths that start with '/', each path once.

    A directory on one side only is removed or restored as a whole, the topmost
    one; a file on one side only, in a directory of both, is removed or restored;
    one with another size or digest is replaced.  Null digests are equal to each
    other only.  A pair of empty trees, or equal ones, has no actions.
    """
    lo, re = (with_directory(x, by) for x in (local, remote))
    changed = _unequal(directory_digests(lo).select("dir", "h1", "h2", "n"), directory_digests(re).select("dir", "h1", "h2", "n"), ["dir"])
    changed = changed.withColumn("parent", F.when(F.col("dir") != "/", F.regexp_replace("dir", "[^/]+/$", "")))
    # A directory of one side has only such directories below it: it is the
    # topmost where its parent is on both sides, or is the empty root.
    alone = changed.where("not (in_a and in_b)")
    under = alone.select(F.col("dir").alias("parent"))
    top = alone.where("dir <> '/'").join(under.where("parent <> '/'"), "parent", "left_anti")
    dirs = top.select(F.col("dir").alias("path"), F.lit(True).alias("is_dir"), F.when(F.col("in_a"), 0).otherwise(1).alias("k"))
    # Files of an empty or absent other side stand in the root alone.
    roots = changed.where("dir = '/' and not (in_a and in_b)").select("dir")
    a, b = candidates(lo, re, changed)
    a, b = (x.union(y.where("dir = '/'").join(roots, "dir", "left_semi").select("path", "dir", "mark")) for x, y in ((a, lo), (b, re)))
    pair = a.select("path", F.struct("mark").alias("a")).join(b.select("path", F.struct("mark").alias("b")), "path", "full_outer")
    files = pair.where(~F.col("a").eqNullSafe(F.col("b"))).select(
        "path", F.lit(False).alias("is_dir"), F.when(F.col("b").isNull(), 2).when(F.col("a").isNull(), 3).otherwise(4).alias("k"))
    acts = dirs.union(files)
    return acts.select("path", "is_dir", F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("k") + 1).alias("action"), (F.col("k") + 1).alias("pass_no"))
