"""File manifests and the plan that reconciles two of them.

A manifest is a DataFrame ``(path, is_dir)`` with root-relative paths that
start with '/' and directories ending in '/'.  Reconciliation is one full
outer join plus an ancestor explode and an anti join -- no prefix-LIKE join
and no per-path loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Action names in pass order (directories before files, removals
# before restorations, as the sequential repair does it).
ACTIONS = ["remove_dir", "restore_dir", "remove_file", "restore_file"]


def strict_ancestor_dirs(path: Column) -> Column:
    """'/a/b/c' or '/a/b/c/' -> ['/a/', '/a/b/'] (never the path itself)."""
    trimmed = F.regexp_replace(path, "/+$", "")
    parts = F.split(trimmed, "/")
    n = F.size(parts)
    idx = F.when(n >= 3, F.sequence(F.lit(2), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(idx, lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))


def manifest_from_files(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Files plus every ancestor directory, distinct: ``(path, is_dir)``.

    One pass: each file row emits itself and its ancestors, then one
    distinct (partially aggregated before the shuffle)."""
    p = F.col(path_col)
    entries = F.concat(
        F.array(F.struct(p.alias("path"), F.lit(False).alias("is_dir"))),
        F.transform(F.filter(strict_ancestor_dirs(p), lambda d: d != "/"),
                    lambda d: F.struct(d.alias("path"), F.lit(True).alias("is_dir"))))
    return files.select(F.inline(entries)).distinct()


def reconcile(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Actions that make ``local`` equal ``remote``.

    A path acts iff it is on one side only and none of its ancestor
    directories is on one side only (that directory's removal or copy already
    covers it).  Output: ``path, is_dir, action, pass_no``.
    """
    lo = local.select("path", F.col("is_dir").alias("_d_l"), F.lit(True).alias("_in_l"))
    re = remote.select("path", F.col("is_dir").alias("_d_r"), F.lit(True).alias("_in_r"))
    j = lo.join(re, "path", "full_outer")
    diff = j.where(F.col("_in_l").isNull() | F.col("_in_r").isNull()).select(
        "path", F.coalesce("_d_l", "_d_r").alias("is_dir"), F.col("_in_l").isNotNull().alias("extra"))
    changed_dirs = diff.where("is_dir").select(F.col("path").alias("anc"), F.lit(True).alias("_hit"))
    # every differing path with each of its ancestors (or none), outer-joined
    # to the differing directories; a path acts when no ancestor matched
    anc = diff.select("path", "is_dir", "extra", F.explode_outer(strict_ancestor_dirs(F.col("path"))).alias("anc"))
    acts = (anc.join(changed_dirs, "anc", "left").groupBy("path", "is_dir", "extra")
            .agg(F.bool_or(F.coalesce("_hit", F.lit(False))).alias("_covered"))
            .where(~F.col("_covered")))
    action = (F.when(F.col("is_dir") & F.col("extra"), F.lit(ACTIONS[0]))
              .when(F.col("is_dir"), F.lit(ACTIONS[1]))
              .when(F.col("extra"), F.lit(ACTIONS[2])).otherwise(F.lit(ACTIONS[3])))
    pass_no = (F.when(F.col("is_dir") & F.col("extra"), 1).when(F.col("is_dir"), 2)
               .when(F.col("extra"), 3).otherwise(4))
    return acts.select("path", "is_dir", action.alias("action"), pass_no.alias("pass_no"))


def reconcile_verdict(actions: DataFrame, fail_fast: bool = True) -> DataFrame:
    """Fix count, and with ``fail_fast`` a failed verdict when anything needed fixing."""
    return actions.agg(F.count(F.lit(1)).alias("fixes")).withColumn(
        "valid", (F.col("fixes") == 0) | F.lit(not fail_fast))
