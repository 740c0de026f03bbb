"""Family N and the key-matching joins: tenancy keys, rosters, provision
plans, batches, and reconcile joins over users (rows 24-29, 31, 48, 134-138)."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from assay.functions import names as N
from assay.operators import tenancy as T
from assay.operators.ordering import batch_of
from assay.plans import standins as S
from assay.plans.registry import query
from assay.sources import sinks
from assay.sources import stored as X
from assay.plans.scalars import _b36_sql

col = F.col

COURSE_CODE = "asdf"

# ----------------------------------------------------------------- joins


@query("missing_resources", """
WITH cl AS (SELECT DISTINCT regexp_replace('odl_user_' || printf('%09d', o_custkey) || '_cluster', '[^0-9]', '', 'g') AS digits
            FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 <> 0)
SELECT c_custkey, c_name FROM customer
WHERE regexp_replace(c_name, '[^0-9]', '', 'g') NOT IN (SELECT digits FROM cl)""")
def missing_resources(t):
    """Row 24: users without a cluster, matched on the digits of the names
    (clusters named after users' numbers; an anti join on the digits); job and
    pipeline clusters do not count."""
    cl = (t.orders.where(col("o_orderstatus") == "F")
          .select(F.concat(F.when(col("o_orderkey") % 10 == 0, "job-").otherwise("odl_user_"), N.zero_pad(col("o_custkey"), 9), F.lit("_cluster"))
                  .alias("cluster_name")))
    return T.missing_by_digits(t.customer.select("c_custkey", "c_name"), "c_name", cl, "cluster_name",
                               user_prefixes=("Customer#", "class+"), skip_prefixes=("dlt-", "job-"))


PROTECTED_USERS = ["legacy-1@example.com"]


def existing_users(t):
    u = S.users(t).where(col("c_custkey") % 3 != 0).select("username")
    legacy = t.supplier.select(F.concat(F.lit("legacy-"), col("s_suppkey").cast("string"), F.lit("@example.com"))
                               .alias("username"))
    return u.unionByName(legacy)


@query("roster_reconcile", f"""
WITH d AS (SELECT username FROM ({S.USERS_SQL})),
e AS (SELECT username FROM ({S.USERS_SQL}) WHERE c_custkey % 3 <> 0
      UNION ALL SELECT 'legacy-' || CAST(s_suppkey AS VARCHAR) || '@example.com' FROM supplier)
SELECT username, 'create' AS action FROM d WHERE username NOT IN (SELECT username FROM e)
UNION ALL
SELECT username, 'remove' FROM e WHERE username NOT IN (SELECT username FROM d) AND username NOT IN ('legacy-1@example.com')""")
def roster_reconcile(t):
    """Row 25: desired vs existing users: create the missing (anti join),
    remove the extra unless protected (anti join the other way)."""
    return T.reconcile_users(S.users(t).select("username"), existing_users(t), "username", PROTECTED_USERS)


def existing_schemas(t):
    """schemas named '<user prefix>_<part name>' for parts whose key is a customer key."""
    p = t.part.select("p_partkey", "p_name")
    name = F.concat(F.lit("customer_"), N.zero_pad(col("p_partkey"), 9), F.lit("_"),
                    N.clean_string(col("p_name"), "_"))
    return p.select(F.lower(name).alias("schema_name"))


@query("prefix_match_users", f"""
WITH u AS (SELECT username, lower(regexp_replace(regexp_replace(split_part(username, '@', 1), '[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g')) AS prefix
           FROM ({S.USERS_SQL})),
s AS (SELECT lower('customer_' || printf('%09d', p_partkey) || '_' ||
             regexp_replace(regexp_replace(p_name, '[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g')) AS schema_name FROM part),
m AS (SELECT DISTINCT u.username FROM u JOIN s ON starts_with(s.schema_name, u.prefix || '_'))
SELECT username, 'has_schema' AS mode FROM m
UNION ALL SELECT username, 'missing_schema' FROM u WHERE username NOT IN (SELECT username FROM m)""")
def prefix_match_users(t):
    """Row 26: users matched to existing schemas by name prefix.  Each schema
    name is exploded into its '_'-delimited prefixes, so the prefix test is
    an equi-join; both the reference's mode (users *with* a match) and the
    intended one (users without) are returned."""
    u = S.users(t)
    return T.prefix_matches(u, "username", F.lower(N.clean_string(F.substring_index("username", "@", 1), "_")),
                            existing_schemas(t), "schema_name")


def references(t):
    """a mixed list of user names and ids, with some unknown entries."""
    c = t.customer.select("c_custkey", "c_name")
    ref = (F.when(col("c_custkey") % 97 == 0, F.concat(F.lit("ghost-"), col("c_custkey").cast("string"), F.lit("@example.com")))
           .when(col("c_custkey") % 2 == 0, F.concat(F.lower("c_name"), F.lit("@example.com")))
           .otherwise(col("c_custkey").cast("string")))
    return c.select(ref.alias("ref"))


@query("resolve_references", f"""
WITH r AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN 'ghost-' || CAST(c_custkey AS VARCHAR) || '@example.com'
                       WHEN c_custkey % 2 = 0 THEN lower(c_name) || '@example.com' ELSE CAST(c_custkey AS VARCHAR) END AS ref
           FROM customer),
u AS ({S.USERS_SQL})
SELECT r.ref, u.c_custkey FROM r LEFT JOIN u ON (contains(r.ref, '@') AND r.ref = u.username)
                                            OR (NOT contains(r.ref, '@') AND r.ref = CAST(u.c_custkey AS VARCHAR))""")
def resolve_references(t):
    """Row 27: references split by '@' into names and ids, each resolved by
    its own equi-join, then unioned; unresolved ones keep a NULL key."""
    return T.resolve_references(references(t), "ref", S.users(t), "username", "c_custkey")


@query("lookup_by_example", """
WITH ex AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS id,
              CASE WHEN o_orderkey % 3 <> 0 THEN 'Customer#' || printf('%09d', o_custkey + (o_orderkey % 7 = 1)::INT * 100000) END AS name
            FROM orders),
m AS (SELECT ex.o_orderkey, min(c.c_custkey) AS c_custkey FROM ex JOIN customer c
        ON (ex.id IS NOT NULL AND c.c_custkey = ex.id) OR (ex.id IS NULL AND c.c_name = ex.name) GROUP BY ex.o_orderkey)
SELECT ex.o_orderkey, m.c_custkey, m.c_custkey IS NULL AS unresolved FROM ex LEFT JOIN m ON ex.o_orderkey = m.o_orderkey""")
def lookup_by_example(t):
    """Row 28: examples resolved by id when they carry one, else by name;
    the first match (lowest key) wins; unresolved examples are reported."""
    o = t.orders.select("o_orderkey", "o_custkey")
    bump = F.when(col("o_orderkey") % 7 == 1, 100000).otherwise(0)
    ex = o.select("o_orderkey", F.when(col("o_orderkey") % 3 == 0, col("o_custkey")).alias("id"),
                  F.when(col("o_orderkey") % 3 != 0,
                         F.concat(F.lit("Customer#"), N.zero_pad((col("o_custkey") + bump), 9))).alias("name"))
    return T.lookup_by_example(ex, "o_orderkey", "id", "name", t.customer, "c_custkey", "c_name")


def incoming_customers(t):
    c = t.customer.where(col("c_custkey") % 3 == 0).select("c_custkey", "c_name", (col("c_acctbal") + 100).alias("c_acctbal"))
    new = t.supplier.select((col("s_suppkey") + 100000).alias("c_custkey"), col("s_name").alias("c_name"),
                            col("s_acctbal").alias("c_acctbal"))
    return c.unionByName(new)


@query("upsert_modes", f"""
WITH b AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
i AS (SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_custkey % 3 = 0
      UNION ALL SELECT s_suppkey + 100000, s_name, s_acctbal FROM supplier),
j AS (SELECT b.c_custkey IS NOT NULL AS in_base, i.c_custkey IS NOT NULL AS in_new FROM b FULL OUTER JOIN i ON b.c_custkey = i.c_custkey),
s AS (SELECT count_if(in_base) AS nb, count_if(in_new AND NOT in_base) AS ins, count_if(in_new AND in_base) AS both_ FROM j),
m AS (SELECT * FROM (VALUES ('create'), ('ignore'), ('update'), ('overwrite'), ('error')) v(mode))
SELECT mode,
  CAST(CASE WHEN mode IN ('create', 'ignore', 'overwrite') THEN nb + ins ELSE nb END AS BIGINT) AS n_rows,
  CAST(CASE WHEN mode IN ('create', 'ignore', 'overwrite') THEN ins ELSE 0 END AS BIGINT) AS n_inserted,
  CAST(CASE WHEN mode IN ('update', 'overwrite') THEN both_ ELSE 0 END AS BIGINT) AS n_updated,
  CAST(CASE WHEN mode IN ('create', 'error') THEN both_ ELSE 0 END AS BIGINT) AS n_conflicts
FROM s, m""")
def upsert_modes(t):
    """Row 29: base vs incoming in one full outer join; per mode the rows
    kept, inserted, updated and the conflicts an 'error' / 'create' run
    reports.  (The merged frame itself is ``upsert(base, new, mode)``.)"""
    return T.upsert_summary(t.customer.select("c_custkey", "c_name", "c_acctbal"), incoming_customers(t), "c_custkey")


@query("stored_upsert", """
WITH i AS (SELECT c_custkey, c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_custkey % 500 = 0
           UNION ALL SELECT s_suppkey + 100000, s_name, s_acctbal FROM supplier),
one AS (SELECT * FROM i UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer c WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.c_custkey = c.c_custkey))
SELECT c_custkey, CASE WHEN c_custkey % 1000 = 0 THEN upper(c_name) ELSE c_name END AS c_name, c_acctbal FROM one""")
def stored_upsert(t):
    """Row 29 on a stored table: a batch that inserts and updates, the same
    batch once more, one that only updates with a key it contradicts itself on,
    and the table as its last manifest has it."""
    root = sinks.new_scratch(t.spark, "stored")
    base = t.customer.select("c_custkey", "c_name", "c_acctbal")
    X.create(base, root, "c_custkey", buckets=64)
    new = (base.where(col("c_custkey") % 500 == 0).withColumn("c_acctbal", col("c_acctbal") + 100)
           .unionByName(t.supplier.select((col("s_suppkey") + 100000).alias("c_custkey"), col("s_name").alias("c_name"), col("s_acctbal").alias("c_acctbal"))))
    for _ in range(2):
        X.upsert(new, root, "c_custkey", "overwrite", "first")
    named = X.read(t.spark, root).where(col("c_custkey") % 1000 == 0).withColumn("c_name", F.upper("c_name"))
    odd = base.where(col("c_custkey") == 1).withColumn("c_name", F.explode(F.array(F.lit("x"), F.lit("y"))))
    X.upsert(named.unionByName(odd), root, "c_custkey", "update", "second")
    return X.read(t.spark, root)


# Group template: group -> market segments whose customers belong ('*' = all).
GROUP_TEMPLATE = {"analysts": ["AUTOMOBILE", "MACHINERY"], "builders": ["BUILDING"], "everyone": ["*"]}


@query("membership_gap", f"""
WITH u AS ({S.USERS_SQL}),
tpl AS (SELECT * FROM (VALUES {', '.join(f"('{g}', '{s}')" for g, ss in GROUP_TEMPLATE.items() for s in ss)}) v(grp, seg)),
want AS (SELECT tpl.grp, u.username FROM tpl JOIN u ON tpl.seg = u.c_mktsegment
         UNION SELECT tpl.grp, u.username FROM tpl, u WHERE tpl.seg = '*'),
have AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'builders' ELSE 'everyone' END AS grp, username FROM u WHERE c_custkey % 2 = 0)
SELECT grp, username, 'add' AS action FROM (SELECT * FROM want EXCEPT SELECT * FROM have)
UNION ALL SELECT grp, username, 'remove' FROM (SELECT * FROM have EXCEPT SELECT * FROM want)""")
def membership_gap(t):
    """Row 31: desired (group, user) pairs from a group template map
    (exploded; the '*' entry is a plain projection, other entries an
    equi-join on segment) against existing memberships, both directions."""
    u = S.users(t).select("c_custkey", "username", "c_mktsegment")
    want = T.desired_memberships(u, "username", "c_mktsegment", GROUP_TEMPLATE)
    have = u.where(col("c_custkey") % 2 == 0).select(
        F.when(col("c_custkey") % 4 == 0, "builders").otherwise("everyone").alias("grp"), "username")
    return T.membership_gap(want, have, ["grp", "username"])


# ----------------------------------------------------------------- tenancy

def _schema_sql(h4: str) -> str:
    return (f"lower(regexp_replace(regexp_replace(split_part(username, '@', 1) || ' ' || {h4} || ' da {COURSE_CODE}', "
            f"'[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g'))")


@query("tenant_keys", f"""
WITH u AS ({S.USERS_SQL}),
h AS (SELECT c_custkey, username, {_b36_sql(f"CAST((('0x' || md5(username || workspace_id))::UHUGEINT % {36 ** 4}) AS BIGINT)", 4)} AS user_hash FROM u),
k AS (SELECT *, {_schema_sql('user_hash')} AS schema_name,
        lower(regexp_replace(regexp_replace(split_part(username, '@', 1) || ' ' || user_hash || ' da', '[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g')) AS catalog_name
      FROM h),
c AS (SELECT user_hash, count(*) AS n FROM k GROUP BY user_hash)
SELECT k.*, c.n > 1 AS collision FROM k JOIN c USING (user_hash)""")
def tenant_keys(t):
    """Rows 64, 134: per user the hash, schema and catalog names, with a
    collision audit (36^4 values: same hash for two users)."""
    u = S.users(t).select("c_custkey", "username", "workspace_id")
    return T.tenant_keys(u, "username", col("workspace_id"), COURSE_CODE).select(
        "user_hash", "c_custkey", "username", "schema_name", "catalog_name", "collision")


USERNAME_PATTERN = "class+{n}@example.com"
WORKSPACE_PATTERN = "ws-{n}"
WORKSPACE_HASH_SEED = "workspace"


def workspace_name(n: int) -> str:
    """Name of workspace ``n`` as the roster builds it (for ignore lists)."""
    v = int(hashlib.md5(f"{WORKSPACE_HASH_SEED}:0:{n}".encode()).hexdigest(), 16)
    digits = "".join(N.BASE36_DIGITS[(v // 36 ** i) % 36] for i in range(5))
    return f"ws-{n:03d}-{digits}"
TEMPLATE_GROUPS = {"instructors": [0, "instructor@example.com"], "analysts": ["analyst@example.com"]}
IGNORED_WORKSPACES = [3, workspace_name(7)]


@query("roster_generate", f"""
WITH w AS (SELECT n_nationkey + 1 AS ws, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS max_p
           FROM nation n),
u AS (SELECT ws, 'class+' || printf('%03d', i) || '@example.com' AS username FROM (SELECT ws, unnest(range(0, max_p + 1)) AS i FROM w)),
extra AS (SELECT ws, x AS username FROM w, (VALUES ('instructor@example.com'), ('analyst@example.com')) v(x)),
a AS (SELECT * FROM u UNION ALL SELECT * FROM extra WHERE username NOT IN (SELECT username FROM u WHERE u.ws = extra.ws))
SELECT name AS workspace, username FROM (
  SELECT *, 'ws-' || printf('%03d', ws) || '-' ||
    {_b36_sql(f"CAST((('0x' || md5('{WORKSPACE_HASH_SEED}:0:' || CAST(ws AS VARCHAR)))::UHUGEINT % {36 ** 5}) AS BIGINT)", 5)} AS name
  FROM a)
WHERE ws NOT IN (3) AND name NOT IN ('{workspace_name(7)}')""")
def roster_generate(t):
    """Rows 75, 135: per workspace (one per nation) users 000..N where N is
    the nation's customer count, plus template group members that are not
    in the list; ignored workspaces (by number or name) are skipped.  The
    sequence is a per-row generator, not a join."""
    n = t.nation.select("n_nationkey")
    cnt = t.customer.groupBy(col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("max_p"))
    w = n.join(cnt, "n_nationkey", "left").select((col("n_nationkey") + 1).alias("ws"),
                                                  F.coalesce("max_p", F.lit(0)).alias("max_p"))
    users = T.generate_range(w, "ws", "max_p").select(
        "ws", F.concat(F.lit("class+"), N.zero_pad(col("i"), 3), F.lit("@example.com")).alias("username"))
    named = [x for g in TEMPLATE_GROUPS.values() for x in g if isinstance(x, str)]
    extra = w.select("ws", F.explode(F.array(*[F.lit(x) for x in named])).alias("username"))
    extra = extra.join(users, ["ws", "username"], "left_anti")
    a = users.unionByName(extra)
    # workspace name: pattern + stable base-36 hash of (seed, 0, number), as the template names them
    ws_name = F.lower(F.concat(F.lit("ws-"), N.zero_pad(col("ws"), 3), F.lit("-"),
                               N.stable_hash(F.lit(WORKSPACE_HASH_SEED), F.lit(0), col("ws"), length=5)))
    nums = [x for x in IGNORED_WORKSPACES if isinstance(x, int)]
    names_ = [x for x in IGNORED_WORKSPACES if isinstance(x, str)]
    return a.where(~col("ws").isin(nums) & ~ws_name.isin(names_)).select(ws_name.alias("workspace"), "username")


PROTECTED_SCHEMAS = ["default", "information_schema"]
SCHEMA_PREFIX = "customer_"


def existing_databases(t):
    """SHOW DATABASES stand-in: schemas of every third user, orphans with the
    user prefix (from parts), and protected schemas."""
    u = S.users(t).where(col("c_custkey") % 3 == 0).select(
        N.schema_name("username", F.lit(COURSE_CODE), col("workspace_id")).alias("name"))
    orphans = t.part.where(col("p_partkey") % 50 == 0).select(
        F.concat(F.lit(SCHEMA_PREFIX), N.zero_pad((col("p_partkey") + 100000), 9),
                 F.lit("_zzzz_da_" + COURSE_CODE)).alias("name"))
    prot = t.spark.createDataFrame([(x,) for x in PROTECTED_SCHEMAS], "name string")
    return u.unionByName(orphans).unionByName(prot)


@query("provision_plan", f"""
WITH u AS ({S.USERS_SQL}),
h AS (SELECT c_custkey, username, {_b36_sql(f"CAST((('0x' || md5(username || workspace_id))::UHUGEINT % {36 ** 4}) AS BIGINT)", 4)} AS user_hash FROM u),
exp AS (SELECT c_custkey, {_schema_sql('user_hash')} AS name FROM h),
ex AS (SELECT name FROM exp WHERE c_custkey % 3 = 0
       UNION ALL SELECT '{SCHEMA_PREFIX}' || printf('%09d', p_partkey + 100000) || '_zzzz_da_{COURSE_CODE}' FROM part WHERE p_partkey % 50 = 0
       UNION ALL SELECT * FROM (VALUES ('default'), ('information_schema')) v(name))
SELECT coalesce(exp.name, ex.name) AS name,
  CASE WHEN exp.name IS NOT NULL AND ex.name IS NULL THEN 'create'
       WHEN exp.name IS NOT NULL AND exp.c_custkey % 6 = 0 THEN 'drop_create'
       WHEN exp.name IS NOT NULL THEN 'skip'
       WHEN ex.name IN ('default', 'information_schema') THEN 'keep'
       WHEN starts_with(ex.name, '{SCHEMA_PREFIX}') THEN 'drop'
       ELSE 'keep' END AS action
FROM exp FULL OUTER JOIN ex ON exp.name = ex.name""")
def provision_plan(t):
    """Rows 136, 138: expected per-user schemas full-outer-joined with the
    existing ones -> create / skip / drop+create (reinstall) / drop of
    orphans with the user prefix; protected names are kept.  A plan only."""
    u = S.users(t)
    exp = u.select(N.schema_name("username", F.lit(COURSE_CODE), col("workspace_id")).alias("name"), "c_custkey")
    return T.provision_plan(exp, existing_databases(t), "name", col("c_custkey") % 6 == 0, SCHEMA_PREFIX,
                            PROTECTED_SCHEMAS)


@query("batch_assign", """
SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS BIGINT) AS batch,
  CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 50 AS BIGINT) AS pos_in_batch
FROM customer""")
def batch_assign(t):
    """Row 48: users in fixed batches of 50 in key order (the reference's
    duplicate-first-batch bug is fixed); a distributed row index, not a
    global window."""
    return batch_of(t.customer.select("c_custkey"), ["c_custkey"], 50)
