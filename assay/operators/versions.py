"""Semantic versions: parsing, ordering, newest-two selection, requested
dataset versions and dependency status -- aggregates, never a per-family
sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.ordering import with_row_index

col = F.col
SEMVER = r"^[0-9]+\.[0-9]+\.[0-9]+$"


def parse(version: Column) -> Column:
    """'N.N.N' -> struct(major, minor, patch) of BIGINTs (NULL fields otherwise)."""
    parts = F.split(version, r"\.")
    return F.struct(*[F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint").alias(n)
                      for i, n in enumerate(["major", "minor", "patch"])])


def order(df: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """Global semantic order (integer parts, then ``keys`` ties) as a
    distributed row index; the reference's weight is added for comparison."""
    d = df.withColumn("weight", col("major") * 10000 + col("minor") * 100 + col("patch"))
    return with_row_index(d, ["major", "minor", "patch", *keys], name)


def top_two(df: DataFrame, family: str = "family") -> DataFrame:
    """Newest and previous distinct version per family: two partial
    aggregations (max, then max of the rest) instead of a per-family sort."""
    d = df.select(family, "version", "major", "minor", "patch").distinct()
    key = F.struct("major", "minor", "patch", "version")
    first = d.groupBy(family).agg(F.max(key).alias("_k1"))
    rest = d.join(first, family).where(key < col("_k1"))
    second = rest.groupBy(family).agg(F.max(key).alias("_k2"))
    return first.join(second, family, "left").select(
        family, col("_k1.version").alias("newest"), col("_k2.version").alias("previous"))


def select_versions(specs: DataFrame, inventory: DataFrame, family: str = "family") -> DataFrame:
    """Requested ``name`` / ``name:version`` specs against an inventory:
    the newest two for a plain name, the pinned version when it exists
    (``missing_version`` otherwise), ``unknown`` for unknown names."""
    s = specs.select("spec", F.split("spec", ":")[0].alias(family),
                     F.when(col("spec").contains(":"), F.split("spec", ":")[1]).alias("pinned"))
    fams = inventory.select(family).distinct()
    top = top_two(inventory, family)
    latest = (s.where(col("pinned").isNull()).join(top, family)
              .select("spec", family, F.explode(F.array_compact(F.array("newest", "previous"))).alias("version"))
              .withColumn("status", F.lit("latest")))
    have = inventory.select(family, col("version").alias("pinned")).distinct().withColumn("_have", F.lit(True))
    pinned = (s.where(col("pinned").isNotNull()).join(fams, family, "left_semi")
              .join(have, [family, "pinned"], "left")
              .select("spec", family, col("pinned").alias("version"),
                      F.when(col("_have"), "pinned").otherwise("missing_version").alias("status")))
    unknown = s.join(fams, family, "left_anti").select(
        "spec", family, F.lit(None).cast("string").alias("version"), F.lit("unknown").alias("status"))
    return latest.unionByName(pinned).unionByName(unknown)


def dependency_status(tags: DataFrame, installed: DataFrame, family: str = "family") -> DataFrame:
    """Tags ('v' stripped) -> newest by semantic order; compared with the
    installed version: match / outdated / branch (not N.N.N)."""
    t = tags.withColumn("_v", F.regexp_replace("tag", "^v", "")).withColumn("_p", parse(col("_v")))
    newest = t.groupBy(family).agg(F.max_by("_v", col("_p")).alias("newest"))
    j = installed.join(newest, family, "left")
    status = (F.when(~col("installed").rlike(SEMVER), "branch")
              .when(col("installed") == col("newest"), "match").otherwise("outdated"))
    return j.select(family, "installed", "newest", status.alias("status"))
