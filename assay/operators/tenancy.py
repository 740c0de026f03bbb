"""Tenancy operators: per-user keys with a collision audit, reconcile joins
between desired and existing users / groups / schemas, reference
resolution, upserts, generated rosters and provision plans.  All joins are
equi-joins (prefix tests become exploded prefixes)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions import names as N

col = F.col


def _starts_with_any(name: str, prefixes: tuple[str, ...]) -> Column:
    return F.coalesce(reduce(lambda x, y: x | y, [col(name).startswith(p) for p in prefixes], F.lit(False)), F.lit(False))


def missing_by_digits(users: DataFrame, user_name: str, resources: DataFrame, resource_name: str,
                      user_prefixes: tuple[str, ...] | None = None, skip_prefixes: tuple[str, ...] = ()) -> DataFrame:
    """Users with no resource whose name carries the same digits (anti join);
    only users with one of ``user_prefixes`` are looked at (None: all), and
    resources with one of ``skip_prefixes`` do not count."""
    d = (resources.where(~_starts_with_any(resource_name, skip_prefixes))
         .select(F.regexp_replace(resource_name, "[^0-9]", "").alias("_d")).distinct())
    if user_prefixes is not None:
        users = users.where(_starts_with_any(user_name, user_prefixes))
    u = users.withColumn("_d", F.regexp_replace(user_name, "[^0-9]", ""))
    return u.join(d, "_d", "left_anti").drop("_d")


def reconcile_users(desired: DataFrame, existing: DataFrame, key: str, protected: list[str] = ()) -> DataFrame:
    """``create`` the desired users that do not exist, ``remove`` the existing
    ones nobody wants (protected names are kept)."""
    j = desired.select(key, F.lit(True).alias("_d")).join(existing.select(key, F.lit(True).alias("_e")), key, "full_outer")
    action = F.when(col("_e").isNull(), "create").when(col("_d").isNull() & ~col(key).isin(list(protected)), "remove")
    return j.select(key, action.alias("action")).where("action is not null")


def prefix_matches(users: DataFrame, user: str, prefix: Column, names: DataFrame, name: str,
                   sep: str = "_") -> DataFrame:
    """Users whose prefix starts an existing name at a ``sep`` boundary: every
    name is exploded into its leading parts, then one semi join.  Both the
    reference's mode (``has_schema``) and the intended one (``missing_schema``)."""
    u = users.select(user, prefix.alias("_prefix"))
    parts = F.split(name, sep)
    lead = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), sep))
    pref = (names.where(F.contains(F.col(name), F.lit(sep)))      # a name without ``sep`` has no leading part
            .select(F.explode(lead).alias("_prefix")).distinct())
    j = u.join(pref.withColumn("_has", F.lit(True)), "_prefix", "left")
    return j.select(user, F.when(col("_has"), "has_schema").otherwise("missing_schema").alias("mode"))


def resolve_references(refs: DataFrame, ref: str, users: DataFrame, name: str, key: str) -> DataFrame:
    """A mixed list of names (with '@') and ids, resolved in one equi-join:
    every user stands under both; unresolved references keep a NULL key."""
    keys = users.select(key, F.explode(F.array(F.struct(F.lit(True).alias("named"), col(name).alias("value")), F.struct(
        F.lit(False).alias("named"), col(key).cast("string").alias("value")))).alias("k")).select(
        key, col("k.named").alias("_named"), col("k.value").alias("_value"))
    j = refs.join(keys, (col(ref).contains("@") == col("_named")) & (col(ref) == col("_value")), "left")
    return j.select(ref, key)


def lookup_by_example(examples: DataFrame, ex_key: str, ex_id: str, ex_name: str, records: DataFrame,
                      rec_id: str, rec_name: str) -> DataFrame:
    """Each example resolved by id when it has one, else by name; the first
    (lowest id) match wins; ``unresolved`` flags the rest."""
    r = records.select(rec_id, rec_name)
    by_id = examples.where(col(ex_id).isNotNull()).join(r, col(ex_id) == col(rec_id)).select(ex_key, rec_id)
    by_name = examples.where(col(ex_id).isNull()).join(r, col(ex_name) == col(rec_name)).select(ex_key, rec_id)
    m = by_id.unionByName(by_name).groupBy(ex_key).agg(F.min(rec_id).alias(rec_id))
    j = examples.select(ex_key).join(m, ex_key, "left")
    return j.select(ex_key, rec_id, col(rec_id).isNull().alias("unresolved"))


# Upsert modes.
MODES = ["create", "ignore", "update", "overwrite", "error"]


def upsert_join(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    vals = [c for c in base.columns if c != key]
    b = base.select(key, *[col(c).alias(f"b_{c}") for c in vals], F.lit(True).alias("_b"))
    n = new.select(key, *[col(c).alias(f"n_{c}") for c in vals], F.lit(True).alias("_n"))
    return (b.join(n, key, "full_outer").withColumn("in_base", F.coalesce("_b", F.lit(False)))
            .withColumn("in_new", F.coalesce("_n", F.lit(False))).drop("_b", "_n"))


def upsert(base: DataFrame, new: DataFrame, mode: str, key: str) -> DataFrame:
    """The merged frame for one mode (create / ignore / update / overwrite);
    ``error`` returns the conflicting keys."""
    vals = [c for c in base.columns if c != key]
    j = upsert_join(base, new, key)
    if mode == "error":
        return j.where(col("in_base") & col("in_new")).select(key)
    take_new = {"create": ~col("in_base"), "ignore": ~col("in_base"), "update": col("in_base") & col("in_new"),
                "overwrite": col("in_new")}[mode]
    keep = col("in_base") | (take_new if mode != "update" else F.lit(False))
    return j.where(keep).select(key, *[F.when(take_new, col(f"n_{c}")).otherwise(col(f"b_{c}")).alias(c) for c in vals])


def upsert_summary(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Per mode the rows kept, inserted, updated and conflicting, from one
    full outer join and one aggregate."""
    j = upsert_join(base, new, key)
    s = j.agg(F.count_if("in_base").alias("nb"), F.count_if(col("in_new") & ~col("in_base")).alias("ins"),
              F.count_if(col("in_new") & col("in_base")).alias("both_"))
    s = s.select(F.explode(F.array(*[F.lit(x) for x in MODES])).alias("mode"), "nb", "ins", "both_")
    ins_modes = col("mode").isin("create", "ignore", "overwrite")
    return s.select("mode",
                    F.when(ins_modes, col("nb") + col("ins")).otherwise(col("nb")).cast("bigint").alias("n_rows"),
                    F.when(ins_modes, col("ins")).otherwise(0).cast("bigint").alias("n_inserted"),
                    F.when(col("mode").isin("update", "overwrite"), col("both_")).otherwise(0).cast("bigint")
                    .alias("n_updated"),
                    F.when(col("mode").isin("create", "error"), col("both_")).otherwise(0).cast("bigint")
                    .alias("n_conflicts"))


def desired_memberships(users: DataFrame, user: str, attr: str, template: dict[str, list[str]]) -> DataFrame:
    """(grp, user) pairs from a template group -> attribute values ('*' = all
    users): the literal template joined on the attribute, '*' groups as a
    projection -- no cross join."""
    spark = users.sparkSession
    tpl = spark.createDataFrame([(g, s) for g, ss in template.items() for s in ss if s != "*"], "grp string, _v string")
    by_attr = tpl.join(users.select(user, col(attr).alias("_v")), "_v").select("grp", user)
    star = [g for g, ss in template.items() if "*" in ss]
    out = by_attr
    if star:
        out = out.unionByName(users.select(F.explode(F.array(*[F.lit(g) for g in star])).alias("grp"), user))
    return out.distinct()


def membership_gap(want: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs to ``add`` (wanted, missing) and to ``remove`` (present, unwanted)."""
    add = want.join(have, keys, "left_anti").withColumn("action", F.lit("add"))
    rem = have.join(want, keys, "left_anti").withColumn("action", F.lit("remove"))
    return add.unionByName(rem)


def tenant_keys(users: DataFrame, user: str, workspace_id: Column, course_code: str) -> DataFrame:
    """Hash, schema and catalog names per user, with a collision audit (two
    users on one 4-character hash)."""
    k = users.withColumn("user_hash", N.user_hash(user, workspace_id))     # computed once, reused below
    k = k.select("*", N.schema_name(user, F.lit(course_code), workspace_id, hash_col="user_hash").alias("schema_name"),
                 N.catalog_name(user, workspace_id, hash_col="user_hash").alias("catalog_name"))
    c = k.groupBy("user_hash").agg(F.count(F.lit(1)).alias("_n"))
    return k.join(c, "user_hash").withColumn("collision", col("_n") > 1).drop("_n")


RANGE_CHUNK = 10_000


def generate_range(df: DataFrame, key: str, upper: str, chunk: int = RANGE_CHUNK) -> DataFrame:
    """Rows ``(key, i)`` for i in 0..upper per input row, generated in two
    levels: chunk starts first (spread over tasks by a shuffle), then at
    most ``chunk`` numbers per chunk, so one huge range is never one array
    or one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = df.select(key, col(upper).cast("bigint").alias("_u"),
                       F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(col(upper) / chunk).cast("bigint")))
                       .alias("_c"))
    starts = starts.repartition(n, key, "_c")
    lo = col("_c") * chunk
    return starts.select(key, F.explode(F.sequence(lo, F.least(lo + chunk - 1, col("_u")))).alias("i"))


def provision_plan(expected: DataFrame, existing: DataFrame, name: str, reinstall: Column, prefix: str,
                   protected: list[str]) -> DataFrame:
    """Expected vs existing schemas in one full outer join: ``create``,
    ``skip``, ``drop_create`` (reinstall), ``drop`` (orphans with the user
    prefix) or ``keep`` (protected / foreign).  A plan only."""
    e = expected.select(name, reinstall.alias("_re"), F.lit(True).alias("_e"))
    x = existing.select(name, F.lit(True).alias("_x"))
    j = e.join(x, name, "full_outer")
    ee, xx = col("_e").isNotNull(), col("_x").isNotNull()
    action = (F.when(ee & ~xx, "create").when(ee & col("_re"), "drop_create").when(ee, "skip")
              .when(col(name).isin(list(protected)), "keep").when(col(name).startswith(prefix), "drop")
              .otherwise("keep"))
    return j.select(name, action.alias("action"))
