"""Family R and the generic projection / filter / aggregate rows: run and
estate reports over nested records (rows 13-20, 34-43, 59, 123-132)."""

from __future__ import annotations


from pyspark.sql import functions as F

from assay.functions.text import left_pad
from assay.operators import reports as R
from assay.operators import unknown as U
from assay.operators.ordering import with_row_index
from assay.plans import standins as S
from assay.plans.registry import query
from assay.plans.scalars import DURATION_LABEL_SQL, duration_label

col = F.col

# ---------------------------------------------------------------- run results


@query("run_sections", f"""
WITH r AS ({S.RUN_RECORDS_SQL})
SELECT suite_id, CAST(count_if(result_state = 'FAILED') AS BIGINT) AS failed,
  CAST(count_if(result_state = 'IGNORED') AS BIGINT) AS ignored,
  CAST(count_if(result_state = 'SUCCESS') AS BIGINT) AS success,
  CAST(count_if(result_state NOT IN ('FAILED', 'IGNORED', 'SUCCESS')) AS BIGINT) AS other,
  count_if(result_state = 'FAILED') = 0 AS passed
FROM r GROUP BY suite_id""")
def run_sections(t):
    """Row 34: results split into FAILED / IGNORED / SUCCESS (plus other);
    a suite passed iff it has no FAILED run.  One grouped pass."""
    return R.run_sections(S.run_records(t), "suite_id", "result_state")


def run_responses(t):
    """events as raw run responses with absent keys (nulls) to normalise."""
    e = t.events.select("event_id", "user_id", "event_type", "value")
    state = F.struct(F.lit("TERMINATED").alias("life_cycle_state"),
                     F.when(col("event_type") == "click", F.lit(None).cast("string"))
                      .when(col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("result_state"),
                     F.lit("").alias("state_message"))
    dur = F.when(col("event_id") % 10 == 0, F.lit(None).cast("bigint")).otherwise(
        F.round(col("value") * 1000).cast("bigint"))
    task = F.struct(F.struct(F.concat(F.lit("/tests/"), col("user_id").cast("string"), F.lit("/"),
                                      col("event_type")).alias("notebook_path")).alias("notebook_task"))
    return e.select(col("user_id").alias("job_id"), col("event_id").alias("run_id"), state.alias("state"),
                    dur.alias("execution_duration"), task.alias("task"),
                    (col("user_id") % 10 == 0).alias("ignore_failures"))


@query("run_records", """
WITH e AS (SELECT * FROM events)
SELECT CAST(user_id AS VARCHAR) AS suite_id, CAST(event_id AS VARCHAR) AS test_id,
  '/tests/' || CAST(user_id AS VARCHAR) || '/' || event_type AS name,
  CASE WHEN event_type = 'click' THEN 'UNKNOWN'
       WHEN event_type = 'error' AND user_id % 10 = 0 THEN 'IGNORED'
       WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS result_state,
  coalesce(CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(round(value * 1000) AS BIGINT) END, 0) AS execution_duration,
  'AWS' AS cloud, 'job-' || CAST(user_id AS VARCHAR) AS job_name, user_id AS job_id, event_id AS run_id,
  '/tests/' || CAST(user_id AS VARCHAR) || '/' || event_type AS notebook_path, '15.4.x' AS spark_version, 'smoke' AS test_type
FROM e""")
def run_records(t):
    """Row 123 (and 9): nested run responses normalised to the 12-field run
    record: absent keys -> 0 / UNKNOWN, FAILED of an ignored test -> IGNORED."""
    r = run_responses(t)
    rs = R.normalized_state(col("state.result_state"), col("ignore_failures"))
    path = F.coalesce(col("task.notebook_task.notebook_path"), F.lit("UNKNOWN"))
    return r.select(col("job_id").cast("string").alias("suite_id"), col("run_id").cast("string").alias("test_id"),
                    path.alias("name"), rs.alias("result_state"),
                    F.coalesce("execution_duration", F.lit(0).cast("bigint")).alias("execution_duration"),
                    F.lit("AWS").alias("cloud"), F.concat(F.lit("job-"), col("job_id").cast("string")).alias("job_name"),
                    "job_id", "run_id", path.alias("notebook_path"), F.lit("15.4.x").alias("spark_version"),
                    F.lit("smoke").alias("test_type"))


@query("run_report", f"""
WITH r AS ({S.RUN_RECORDS_SQL}),
p AS (SELECT *, '/tests/' || suite_id || '/' || CASE WHEN length(test_id) < 8 THEN lpad(test_id, 8, '0') ELSE test_id END AS notebook_path,
        CASE result_state WHEN 'FAILED' THEN 1 WHEN 'IGNORED' THEN 2 ELSE 3 END AS section FROM r)
SELECT section, notebook_path, result_state, {DURATION_LABEL_SQL.format(d='execution_duration')} AS duration,
  CAST(row_number() OVER (ORDER BY section, notebook_path) - 1 AS BIGINT) AS position
FROM p""")
def run_report(t):
    """Row 124: report rows by section (Failed, Ignored, Success), sorted by
    path, with duration labels; the order is a distributed row index."""
    r = S.run_records(t)
    p = r.select(F.concat(F.lit("/tests/"), col("suite_id"), F.lit("/"), left_pad("test_id", 8, "0")).alias("notebook_path"),
                 F.when(col("result_state") == "FAILED", 1).when(col("result_state") == "IGNORED", 2)
                 .otherwise(3).alias("section"),
                 "result_state", duration_label(col("execution_duration")).alias("duration"))
    return R.report_order(p, ["section", "notebook_path"], "position")


@query("cleanup_eligible", f"""
WITH runs AS ({S.JOB_RUNS_SQL}),
g AS (SELECT job_id, CAST(count(*) AS BIGINT) AS n_runs,
        bool_and(life_cycle_state = 'TERMINATED' AND coalesce(result_state = 'SUCCESS', false)) AS all_ok
      FROM runs GROUP BY job_id)
SELECT c.c_custkey AS job_id, coalesce(g.n_runs, 0) AS n_runs, coalesce(g.all_ok, true) AS eligible
FROM customer c LEFT JOIN g ON c.c_custkey = g.job_id""")
def cleanup_eligible(t):
    """Row 36: a job may be deleted when all its runs are TERMINATED and
    SUCCESS; a job with zero runs is eligible."""
    jobs = t.customer.select(col("c_custkey").alias("job_id"))
    return R.cleanup_eligible(jobs, S.job_runs(t), "job_id", "life_cycle_state", "result_state")


@query("ambiguous_names", """
SELECT p_name, CAST(count(*) AS BIGINT) AS n, min(p_partkey) AS first_id, max(p_partkey) AS last_id
FROM part GROUP BY p_name HAVING count(*) > 1""")
def ambiguous_names(t):
    """Row 37: names that resolve to more than one record (bounded output:
    count and id range rather than the id list)."""
    return R.ambiguous(t.part, "p_name", "p_partkey")


@query("severity_rollup", """
WITH c AS (SELECT user_id AS thread, CAST(count_if(event_type = 'click') AS BIGINT) AS warnings,
             CAST(count_if(event_type = 'signup') AS BIGINT) AS errors,
             CAST(count_if(event_type = 'error') AS BIGINT) AS exceptions FROM events GROUP BY user_id)
SELECT thread, warnings, errors, exceptions,
  '| ' || trim(CASE WHEN exceptions > 0 THEN ' ' || CAST(exceptions AS VARCHAR) || ' Exceptions |' ELSE '' END ||
               CASE WHEN errors > 0 THEN ' ' || CAST(errors AS VARCHAR) || ' Errors |' ELSE '' END ||
               CASE WHEN warnings > 0 THEN ' ' || CAST(warnings AS VARCHAR) || ' Warnings |' ELSE '' END) AS label,
  CASE WHEN errors > 0 OR exceptions > 0 THEN 'danger' ELSE 'warning' END AS color
FROM c""")
def severity_rollup(t):
    """Row 38: per thread the non-zero severity counts as one label and a
    colour (danger on any error or exception)."""
    et = col("event_type")
    return R.severity_rollup(t.events, "user_id", et == "click", et == "signup", et == "error")


@query("completeness_vs_baseline", """
WITH u AS (SELECT c_custkey AS user_id FROM customer),
c AS (SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY user_id),
b AS (SELECT arg_min(n, user_id) AS baseline FROM c)
SELECT u.user_id, c.n AS file_count, b.baseline,
  CASE WHEN c.n IS NULL THEN 'missing' WHEN c.n > b.baseline THEN 'extra files found' ELSE 'half imported' END AS status
FROM u LEFT JOIN c ON u.user_id = c.user_id, b
WHERE c.n IS NULL OR c.n <> b.baseline""")
def completeness_vs_baseline(t):
    """Row 40: per user file count against the first user's count: extra,
    half imported, or missing (no folder).  The baseline is a one-row
    aggregate used as a scalar subquery."""
    users = t.customer.select(col("c_custkey").alias("user_id"))
    return R.completeness(users, t.events.select("user_id"), "user_id")


@query("round_index", """
SELECT CAST(p_size % 4 AS INTEGER) AS test_round, p_partkey, p_name,
  CAST(row_number() OVER (ORDER BY p_size % 4, p_partkey) - 1 AS BIGINT) AS position
FROM part""")
def round_index(t):
    """Rows 41, 57: notebooks indexed by round then order (multi-key order as
    a distributed row index)."""
    p = t.part.select((col("p_size") % 4).cast("int").alias("test_round"), "p_partkey", "p_name")
    return with_row_index(p, ["test_round", "p_partkey"], "position")


# The title pattern and the cloud columns of the pivot.
TITLE_PATTERN = r"^([^-]*)-([^|]*[^ |])( *\|.*)$"
CLOUDS = ["EN", "FR", "DE", "ES"]


def lab_titles(t):
    d = t.documents.select("doc_id", "lang", "source")
    s = F.concat(F.upper("lang"), F.lit("-Course "), col("source"),
                 F.when(col("doc_id") % 2 == 0, F.lit(" | Lab")).otherwise(F.lit("")))
    return d.select("doc_id", s.alias("long_title"))


@query("title_cloud_pivot", f"""
WITH s AS (SELECT upper(lang) || '-Course ' || source || CASE WHEN doc_id % 2 = 0 THEN ' | Lab' ELSE '' END AS long_title
           FROM documents),
m AS (SELECT regexp_extract(long_title, '{TITLE_PATTERN}', 1) AS cloud,
             regexp_extract(long_title, '{TITLE_PATTERN}', 2) AS title FROM s
      WHERE regexp_matches(long_title, '{TITLE_PATTERN}'))
SELECT title, {', '.join(f"CAST(count_if(cloud = '{c}') AS BIGINT) AS {c}" for c in CLOUDS)} FROM m GROUP BY title""")
def title_cloud_pivot(t):
    """Rows 42, 72: lab titles split by regex into cloud and title, then a
    pivot with a fixed value list (no distinct pass to discover columns)."""
    s = lab_titles(t)
    m = (s.where(col("long_title").rlike(TITLE_PATTERN))
         .select(F.regexp_extract("long_title", TITLE_PATTERN, 1).alias("cloud"),
                 F.regexp_extract("long_title", TITLE_PATTERN, 2).alias("title")))
    return (m.groupBy("title").pivot("cloud", CLOUDS).agg(F.count(F.lit(1))).na.fill(0, CLOUDS))


REQUIRED_GROUPS = ["signup", "purchase", "error", "view", "click", "refund"]


@query("required_groups_gate", f"""
WITH req AS (SELECT * FROM (VALUES {', '.join(f"('{g}')" for g in REQUIRED_GROUPS)}) v(grp)),
g AS (SELECT event_type AS grp, bool_and(value > 0) AS passed FROM events GROUP BY event_type),
j AS (SELECT req.grp, g.grp IS NOT NULL AS present, coalesce(g.passed, false) AS passed FROM req LEFT JOIN g ON req.grp = g.grp)
SELECT j.*, (SELECT bool_and(present AND passed) FROM j) AS gate FROM j""")
def required_groups_gate(t):
    """Row 43: every required group present and passing."""
    return R.required_groups_gate(REQUIRED_GROUPS, t.events, "event_type", col("value") > 0)


@query("pattern_counts", """
SELECT c_nationkey, CAST(count_if(contains(c_name, 'Customer#')) AS BIGINT) AS users,
  CAST(count_if(contains(c_mktsegment, 'BUILD')) AS BIGINT) AS instructors
FROM customer GROUP BY c_nationkey""")
def pattern_counts(t):
    """Row 35: counts of names matching patterns, per nation."""
    return R.pattern_counts(t.customer, ["c_nationkey"], {"users": col("c_name").contains("Customer#"),
                                                           "instructors": col("c_mktsegment").contains("BUILD")})


# ------------------------------------------------------------- ACL and owners

def acls(t):
    """customer -> object with a nested access-control list."""
    u = S.users(t)
    k = col("c_custkey")
    perm = lambda level, inherited: F.struct(F.lit(level).alias("permission_level"),
                                             inherited.alias("inherited"))
    user_entry = F.struct(col("username").alias("user_name"), F.lit(None).cast("string").alias("group_name"),
                          F.lit(None).cast("string").alias("service_principal_name"),
                          F.array(F.struct(F.when(k % 4 == 0, "IS_OWNER").otherwise("CAN_MANAGE").alias("permission_level"),
                                           F.lit(False).alias("inherited")),
                                  perm("CAN_VIEW", F.when(k % 3 == 0, True).when(k % 3 == 1, False))   # else absent
                                  ).alias("all_permissions"))
    group_entry = F.struct(F.lit(None).cast("string").alias("user_name"), col("c_mktsegment").alias("group_name"),
                           F.lit(None).cast("string").alias("service_principal_name"),
                           F.array(perm("CAN_RUN", k % 2 == 0)).alias("all_permissions"))
    # an entry may name two principals
    sp_entry = F.struct(F.lit(None).cast("string").alias("user_name"), F.when(k % 10 == 0, "ops").alias("group_name"),
                        F.concat(F.lit("sp-"), col("c_nationkey").cast("string")).alias("service_principal_name"),
                        F.array(perm("IS_OWNER", F.lit(False))).alias("all_permissions"))
    acl = F.when(k % 5 == 0, F.array(user_entry, group_entry, sp_entry)).otherwise(F.array(user_entry, group_entry))
    return u.select(k.alias("object_id"), acl.alias("access_control_list"))


_ACL_SQL = f"""
WITH u AS ({S.USERS_SQL}),
e AS (
  SELECT c_custkey AS object_id, 'user' AS principal_type, username AS principal,
         CASE WHEN c_custkey % 4 = 0 THEN 'IS_OWNER' ELSE 'CAN_MANAGE' END AS permission_level, false AS inherited FROM u
  UNION ALL SELECT c_custkey, 'user', username, 'CAN_VIEW', c_custkey % 3 = 0 FROM u
  UNION ALL SELECT c_custkey, 'group', c_mktsegment, 'CAN_RUN', c_custkey % 2 = 0 FROM u
  UNION ALL SELECT c_custkey, 'group', 'ops', 'IS_OWNER', false FROM u WHERE c_custkey % 10 = 0
  UNION ALL SELECT c_custkey, 'service_principal', 'sp-' || CAST(c_nationkey AS VARCHAR), 'IS_OWNER', false FROM u WHERE c_custkey % 5 = 0)"""


@query("acl_flatten", _ACL_SQL + """
SELECT object_id, principal_type, principal, permission_level FROM e WHERE NOT inherited""")
def acl_flatten(t):
    """Row 125: nested ACL -> (principal kind, principal, non-inherited
    permission) rows: explode entries, unpivot principal columns, explode
    permissions."""
    return R.flatten_acl(acls(t), "object_id")


@query("owner_resolution", _ACL_SQL + """,
o AS (SELECT object_id, list_sort(list_distinct(list(principal))) AS owners FROM e
      WHERE permission_level = 'IS_OWNER' AND NOT inherited GROUP BY object_id)
SELECT c.c_custkey AS object_id, CAST(coalesce(len(o.owners), 0) AS INTEGER) AS n_owners,
  CASE WHEN len(o.owners) = 1 THEN o.owners[1] END AS owner,
  coalesce(len(o.owners), 0) <> 1 AS ambiguous
FROM customer c LEFT JOIN o ON c.c_custkey = o.object_id""")
def owner_resolution(t):
    """Row 126: the owner of each object; ambiguous when not exactly one
    (owner sets are per object ACLs, so bounded)."""
    return R.resolve_owners(R.flatten_acl(acls(t), "object_id"),
                            t.customer.select(col("c_custkey").alias("object_id")), "object_id")


@query("stale_entities", f"""
WITH p AS (SELECT c_custkey AS pipeline_id, c_custkey % 2 = 0 AS continuous FROM customer),
u AS (SELECT user_id, max(ts) AS last_update FROM events GROUP BY user_id)
SELECT p.pipeline_id, u.last_update,
  CAST(floor(date_diff('microsecond', u.last_update, TIMESTAMP '{S.NOW}') / 60000000) AS BIGINT) AS minutes_since
FROM p LEFT JOIN u ON p.pipeline_id = u.user_id
WHERE p.continuous AND (u.last_update IS NULL OR u.last_update < TIMESTAMP '{S.NOW}' - INTERVAL 30 MINUTE)""")
def stale_entities(t):
    """Row 127: continuous pipelines whose last update is missing or older
    than 30 minutes before 'now' (a parameter)."""
    p = t.customer.select(col("c_custkey").alias("pipeline_id"))
    u = t.events.select(col("user_id").alias("pipeline_id"), "ts")
    return R.stale(p, u, "pipeline_id", "ts", col("pipeline_id") % 2 == 0, S.now_col(), 30)


@query("paged_union", """SELECT DISTINCT conv_id, turn, role FROM conversations""")
def paged_union(t):
    """Row 128: result pages landed as JSON (each page repeats the last item
    of the previous one), read back, exploded and de-duplicated on the id."""
    c = t.conversations.select("conv_id", "turn", "role")
    page_no = F.floor(col("turn") / 2).cast("bigint")
    # a page holds turns 2p, 2p+1 and repeats turn 2p-1 (overlap)
    items = c.select("conv_id", "turn", "role", page_no.alias("page")).unionByName(
        c.where(col("turn") % 2 == 1).select("conv_id", "turn", "role", (page_no + 1).alias("page")))
    pages = items.groupBy("conv_id", "page").agg(
        F.to_json(F.collect_list(F.struct("turn", "role"))).alias("body"))
    return R.union_pages(pages, "body", "turn:bigint,role:string", ["conv_id"], ["turn", "role"])


@query("run_filter", f"""
WITH runs AS ({S.JOB_RUNS_SQL})
SELECT job_id, run_id, start_time FROM runs
WHERE life_cycle_state = 'TERMINATED' AND job_id = 7
  AND start_time >= TIMESTAMP '2024-01-05' AND start_time < TIMESTAMP '2024-01-25'
ORDER BY start_time DESC, run_id DESC LIMIT 25 OFFSET 5""")
def run_filter(t):
    """Row 129: completed runs of one job in a time range, newest first,
    offset 5 limit 25 (paging is the feature; the filters reach the scan)."""
    r = S.job_runs(t).select("job_id", "run_id", "start_time", "life_cycle_state")
    f = R.filter_runs(r, job="job_id", job_id=7, state="life_cycle_state", states=["TERMINATED"], ts="start_time",
                      start="2024-01-05", end="2024-01-25", order=[col("start_time").desc(), col("run_id").desc()],
                      offset=5, limit=25)
    return f.select("job_id", "run_id", "start_time")


@query("entitlement_changes", """
WITH m AS (SELECT c_custkey,
  c_custkey % 2 = 0 AS wa,
  CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS sql_access,
  c_acctbal > 5000 AS cc FROM customer)
SELECT c_custkey,
  concat_ws(',', CASE WHEN cc THEN 'allow-cluster-create' END, CASE WHEN sql_access THEN 'sql-access' END,
            CASE WHEN wa THEN 'workspace-access' END) AS adds,
  concat_ws(',', CASE WHEN NOT cc THEN 'allow-cluster-create' END, CASE WHEN NOT sql_access THEN 'sql-access' END,
            CASE WHEN NOT wa THEN 'workspace-access' END) AS removes
FROM m""")
def entitlement_changes(t):
    """Row 130: a map of entitlement -> wanted (true add, false remove, null
    skip) to sorted add and remove lists, per row (no shuffle)."""
    c = t.customer
    m = F.create_map(F.lit("workspace-access"), col("c_custkey") % 2 == 0,
                     F.lit("sql-access"),
                     F.when(col("c_custkey") % 3 == 0, True).when(col("c_custkey") % 3 == 1, False),
                     F.lit("allow-cluster-create"), col("c_acctbal") > 5000)
    return R.entitlement_changes(c, "c_custkey", m)


NAME_PREFIXES = ["sma", "ring", "blu"]


@query("name_part_match", f"""
WITH p AS (SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part)
SELECT DISTINCT p_partkey, name,
  len(list_filter(string_split(name, '_'), lambda x: x IN ({', '.join(f"'{x}'" for x in NAME_PREFIXES)}))) > 0 AS exact_match,
  len(list_filter(string_split(name, '_'), lambda x: {' OR '.join(f"starts_with(x, '{x}')" for x in NAME_PREFIXES)})) > 0 AS prefix_match
FROM p""")
def name_part_match(t):
    """Row 131: underscore parts of a name matched exactly or by prefix
    against a list; each name once."""
    return R.name_part_match(t.part, "p_partkey", F.translate("p_name", " ", "_"), NAME_PREFIXES)


@query("scan_union", """
SELECT 'orders' AS source, o_orderkey AS id, NULL AS name, NULL AS nationkey, NULL AS acctbal, o_totalprice AS totalprice,
  NULL AS error FROM orders
UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, c_acctbal, NULL, NULL FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL, NULL FROM supplier
UNION ALL SELECT 'partsupp', NULL, NULL, NULL, NULL, NULL, 'source not available'""")
def scan_union(t):
    """Rows 59, 132: heterogeneous per-source records merged by name (missing
    columns null), fixed lead columns, a failing source as an error row."""
    frames = {
        "orders": t.orders.select(col("o_orderkey").alias("id"), col("o_totalprice").alias("totalprice")),
        "customer": t.customer.select(col("c_custkey").alias("id"), col("c_name").alias("name"),
                                      col("c_nationkey").alias("nationkey"), col("c_acctbal").alias("acctbal")),
        "supplier": t.supplier.select(col("s_suppkey").alias("id"), col("s_name").alias("name"),
                                      col("s_nationkey").alias("nationkey"), col("s_acctbal").alias("acctbal")),
    }
    u = R.union_sources(frames, ["id"], {"partsupp": "source not available"})
    return u.select("source", "id", "name", "nationkey", "acctbal", "totalprice", "error")


def raw_records(t):
    """source, body: JSON texts as sources send them.  Order bodies hold a field
    with two kinds and one that some lack, customer bodies nest, some event
    bodies are cut off or missing."""
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    of = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    customer = F.when(col("o_orderkey") % 50 == 0, of('"C-', col("o_custkey"), '"')).otherwise(col("o_custkey").cast("string"))
    note = F.when(col("o_orderkey") % 3 == 0, of(',"note":"', col("o_orderstatus"), '"')).otherwise("")
    orders = t.orders.select(F.lit("orders").alias("source"),
                             of('{"id":', col("o_orderkey"), ',"customer":', customer, ',"price":', col("o_totalprice"), note, "}").alias("body"))
    customers = t.customer.select(F.lit("customer").alias("source"), of(
        '{"id":', col("c_custkey"), ',"name":', text(col("c_name")), ',"place":{"nation":', col("c_nationkey"), ',"segment":', text(col("c_mktsegment")),
        '},"tags":[', text(col("c_mktsegment")), ",", col("c_nationkey"), "],\"closed\":null}").alias("body"))
    body = F.when(col("event_id") % 103 == 0, None).when(col("event_id") % 101 == 0, F.expr("left(props, length(props) - 1)")).otherwise(col("props"))
    return orders.union(customers).union(t.events.select(F.lit("events"), body))


RAW_SQL = """
SELECT 'orders' AS source, '{"id":' || o_orderkey || ',"customer":' || CASE WHEN o_orderkey % 50 = 0 THEN '"C-' || o_custkey || '"' ELSE o_custkey::VARCHAR END
  || ',"price":' || o_totalprice || CASE WHEN o_orderkey % 3 = 0 THEN ',"note":"' || o_orderstatus || '"' ELSE '' END || '}' AS body FROM orders
UNION ALL SELECT 'customer', '{"id":' || c_custkey || ',"name":"' || c_name || '","place":{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment
  || '"},"tags":["' || c_mktsegment || '",' || c_nationkey || '],"closed":null}' FROM customer
UNION ALL SELECT 'events', CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN left(props, length(props) - 1) ELSE props END FROM events"""


@query("discovered_fields", rf"""
WITH r AS ({RAW_SQL}),
k AS (
  SELECT source, '' AS path, CASE WHEN body IS NULL THEN 'missing' ELSE 'unparsable' END AS kind FROM r WHERE body IS NULL OR NOT json_valid(body)
  UNION ALL
  SELECT source, regexp_replace(regexp_replace(fullkey, '^\$\.?', ''), '\[\d+\]', '[]', 'g'),
    CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null'
      WHEN 'DOUBLE' THEN 'decimal' ELSE 'integer' END
  FROM (SELECT * FROM r WHERE body IS NOT NULL AND json_valid(body)) v, json_tree(v.body)),
c AS (SELECT source, path, kind, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY ALL)
SELECT *, CAST(count(*) OVER w AS BIGINT) AS n_kinds,
  len(list_distinct(list(CASE WHEN kind = 'integer' THEN 'decimal' WHEN kind <> 'null' THEN kind END) OVER w)) > 1 AS conflict
FROM c WINDOW w AS (PARTITION BY source, path)""")
def discovered_fields(t):
    """Rows 59, 132: records of unknown schema: which kinds of values stand
    at which path of each source, with conflicts, cut-off and missing bodies."""
    return U.discovered_fields(raw_records(t))


@query("unknown_union", """
SELECT 'orders' AS source, o_orderkey AS id, CASE WHEN o_orderkey % 50 = 0 THEN 'C-' ELSE '' END || o_custkey AS customer,
  o_totalprice::DOUBLE AS price, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS note, NULL::VARCHAR AS name, NULL::VARCHAR AS place,
  NULL::VARCHAR AS tags, NULL::BIGINT AS k FROM orders
UNION ALL SELECT 'customer', c_custkey, NULL, NULL, NULL, c_name, '{"nation":' || c_nationkey || ',"segment":"' || c_mktsegment || '"}',
  '["' || c_mktsegment || '",' || c_nationkey || ']', NULL FROM customer
UNION ALL SELECT 'events', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN event_id % 103 = 0 OR event_id % 101 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END FROM events""")
def unknown_union(t):
    """Rows 59, 132: the same records as one table whose columns and types
    are found in the data; the field with two kinds is text."""
    return U.union_unknown(raw_records(t))


def clusters(t):
    """one cluster per user, started at the user's first event."""
    g = t.events.groupBy("user_id").agg(F.min("ts").alias("start_time"))
    return g.select(col("user_id").alias("cluster_id"), "start_time",
                    F.when(col("user_id") % 4 == 0, "TERMINATED").otherwise("RUNNING").alias("state"))


@query("running_uptime", f"""
WITH c AS (SELECT user_id AS cluster_id, min(ts) AS start_time,
             CASE WHEN user_id % 4 = 0 THEN 'TERMINATED' ELSE 'RUNNING' END AS state FROM events GROUP BY user_id)
SELECT cluster_id, round(date_diff('microsecond', start_time, TIMESTAMP '{S.NOW}') / 1000 / 3600000.0, 1) AS uptime_hours,
  round(date_diff('microsecond', start_time, TIMESTAMP '{S.NOW}') / 1000 / 3600000.0, 1) > 12 AS over_12h
FROM c WHERE state <> 'TERMINATED'""")
def running_uptime(t):
    """Row 17: non-terminated clusters with uptime in hours (1 dp) from a
    'now' parameter, and the over-12-hours flag."""
    c = clusters(t).where(col("state") != "TERMINATED")
    up = R.uptime_hours(col("start_time"), S.now_col())
    return c.select("cluster_id", up.alias("uptime_hours"), (up > 12).alias("over_12h"))


def jobs_with_settings(t):
    e = t.events.select("event_id", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    sched = F.when(k % 3 == 0, F.struct(F.lit("0 0 * * * ?").alias("quartz_cron_expression"),
                                         F.when(k % 2 == 0, "PAUSED").otherwise("UNPAUSED").alias("pause_status")))
    settings = F.struct(sched.alias("schedule"), F.concat(F.lit("job-"), col("event_id").cast("string")).alias("name"))
    return e.select(col("event_id").alias("job_id"), settings.alias("settings"))


@query("scheduled_filter", """
WITH j AS (SELECT event_id AS job_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT job_id, k % 3 = 0 AS has_schedule, k % 3 = 0 AND k % 2 = 0 AS paused,
  k % 3 = 0 AND k % 2 <> 0 AS active FROM j""")
def scheduled_filter(t):
    """Row 18: nested-field predicates: has a schedule, is paused, is active."""
    j = jobs_with_settings(t)
    has = col("settings.schedule").isNotNull()
    paused = F.coalesce(col("settings.schedule.pause_status") == "PAUSED", F.lit(False))
    return j.select("job_id", has.alias("has_schedule"), paused.alias("paused"), (has & ~paused).alias("active"))


def users_nested(t):
    u = S.users(t)
    k = col("c_custkey")
    ent = F.array_compact(F.array(
        F.when(k % 2 == 0, F.struct(F.lit("allow-cluster-create").alias("value"))),
        F.when(k % 3 == 0, F.struct(F.lit("sql-access").alias("value"))),
        F.struct(F.lit("workspace-access").alias("value"))))
    groups = F.array_compact(F.array(
        F.struct(F.when(k % 13 != 0, "users").alias("display")),          # absent names
        F.when(k % 7 == 0, F.struct(F.lit("admins").alias("display")))))
    groups = F.when(k % 11 != 0, groups)                                  # users without the field
    return u.select(k.cast("string").alias("id"), col("username").alias("userName"), ent.alias("entitlements"),
                    groups.alias("groups"))


@query("entitlement_audit", f"""
WITH u AS ({S.USERS_SQL})
SELECT CAST(c_custkey AS VARCHAR) AS id, username AS userName FROM u 
WHERE c_custkey % 2 = 0 AND NOT (c_custkey % 7 = 0 AND c_custkey % 11 <> 0)""")
def entitlement_audit(t):
    """Row 19: users holding an entitlement while not in the admins group."""
    return R.holders_outside(users_nested(t), "allow-cluster-create", "admins").select("id", "userName")


# Column contract (row 20): (column, expected type, min_length, min_value, non_none)
CONTRACT = [
    ("o_orderpriority", "string", 7, None, True),
    ("o_totalprice", "double", None, 100000, True),
    ("o_orderstatus", "int", None, None, True),
    ("o_custkey", "bigint", None, None, True),
]


@query("column_contract", """
WITH o AS (SELECT * FROM orders)
SELECT 'o_orderpriority' AS column_name, 'Error-Not-None' AS error_code, CAST(count_if(o_orderpriority IS NULL) AS BIGINT) AS violations FROM o
UNION ALL SELECT 'o_orderpriority', 'Error-Min-Len', CAST(count_if(length(o_orderpriority) < 7) AS BIGINT) FROM o
UNION ALL SELECT 'o_totalprice', 'Error-Not-None', CAST(count_if(o_totalprice IS NULL) AS BIGINT) FROM o
UNION ALL SELECT 'o_totalprice', 'Error-Min-Value', CAST(count_if(o_totalprice < 100000) AS BIGINT) FROM o
UNION ALL SELECT 'o_orderstatus', 'Error-Not-None', CAST(count_if(o_orderstatus IS NULL) AS BIGINT) FROM o
UNION ALL SELECT 'o_orderstatus', 'Error-Type', CAST(count_if(o_orderstatus IS NOT NULL AND TRY_CAST(o_orderstatus AS INTEGER) IS NULL) AS BIGINT) FROM o
UNION ALL SELECT 'o_custkey', 'Error-Not-None', CAST(count_if(o_custkey IS NULL) AS BIGINT) FROM o""")
def column_contract(t):
    """Row 20: a parameter contract applied to whole columns in one
    aggregate pass: one count per (column, error code)."""
    return R.column_contract(t.orders, CONTRACT)


ALLOWED_KEYS = ["o_orderkey", "o_totalprice", "o_comment", "o_orderdate"]


@query("project_allowlist", "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def project_allowlist(t):
    """Row 13: keep only allow-listed columns that exist (column pruning
    reaches the parquet scan)."""
    return R.select_allowed(t.orders, ALLOWED_KEYS)


INCLUDE_BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#77"]
EXCLUDE_BRANDS = ["Brand#3", "Brand#4", "Brand#88"]


@query("list_partition_audit", f"""
WITH b AS (SELECT DISTINCT p_brand AS brand FROM part),
i AS (SELECT * FROM (VALUES {', '.join(f"('{x}')" for x in INCLUDE_BRANDS)}) v(brand)),
e AS (SELECT * FROM (VALUES {', '.join(f"('{x}')" for x in EXCLUDE_BRANDS)}) v(brand)),
a AS (SELECT brand FROM b UNION SELECT brand FROM i UNION SELECT brand FROM e)
SELECT a.brand, i.brand IS NOT NULL AS included, e.brand IS NOT NULL AS excluded, b.brand IS NOT NULL AS exists_,
  CASE WHEN b.brand IS NULL THEN 'unknown' WHEN i.brand IS NOT NULL AND e.brand IS NOT NULL THEN 'both'
       WHEN i.brand IS NULL AND e.brand IS NULL THEN 'neither' END AS problem
FROM a LEFT JOIN b ON a.brand = b.brand LEFT JOIN i ON a.brand = i.brand LEFT JOIN e ON a.brand = e.brand
WHERE b.brand IS NULL OR (i.brand IS NOT NULL AND e.brand IS NOT NULL) OR (i.brand IS NULL AND e.brand IS NULL)""")
def list_partition_audit(t):
    """Row 14: include and exclude lists must be disjoint, name existing
    values and together cover all of them."""
    return R.list_partition_audit(t.part, "p_brand", INCLUDE_BRANDS, EXCLUDE_BRANDS).withColumnRenamed("p_brand", "brand")


@query("predicate_tagging", """
SELECT p_partkey, p_type = 'PROMO' AS ignored, CASE WHEN p_size > 40 THEN 3 ELSE 2 END AS test_round
FROM part WHERE NOT starts_with(p_name, 'hot ')""")
def predicate_tagging(t):
    """Row 15: caller predicates as Columns: exclude, ignore-failures flag,
    test-round assignment."""
    return R.tag_by_predicates(t.part, exclude=col("p_name").startswith("hot "),
                               ignore=col("p_type") == "PROMO", round_pred=col("p_size") > 40, round_no=3) \
        .select("p_partkey", "ignored", "test_round")


def _rel_paths_spark(t):
    p = S.page_paths(t)
    host = F.split("path", "/")[1]
    rest = F.regexp_replace("path", "^/[^/]+/", "")
    rel = (F.when(col("page_id") % 50 == 0, F.lit("includes/Reset"))
           .when(col("page_id") % 51 == 0, F.lit("Includes/Workspace-Setup"))
           .when(col("page_id") % 9 == 0, F.concat(F.lit("includes/"), host))
           .when(col("page_id") % 13 == 0, F.concat(F.lit("WIP/"), rest))
           .otherwise(F.concat(host, F.lit("/"), rest)))
    return p.select("page_id", rel.alias("path"))


@query("path_classification", f"""
WITH p AS ({S.PAGE_PATHS_SQL}),
r AS (SELECT page_id, CASE WHEN page_id % 50 = 0 THEN 'includes/Reset' WHEN page_id % 51 = 0 THEN 'Includes/Workspace-Setup'
        WHEN page_id % 9 = 0 THEN 'includes/' || split_part(path, '/', 2)
        WHEN page_id % 13 = 0 THEN 'WIP/' || regexp_replace(path, '^/[^/]+/', '')
        ELSE split_part(path, '/', 2) || '/' || regexp_replace(path, '^/[^/]+/', '') END AS path FROM p),
o AS (SELECT *, row_number() OVER (ORDER BY path, page_id) - 1 AS nat FROM r)
SELECT page_id, path,
  CAST(CASE WHEN lower(path) = 'includes/reset' THEN 0 WHEN lower(path) = 'includes/workspace-setup' THEN 1 ELSE nat END AS BIGINT) AS notebook_order,
  CASE WHEN lower(path) IN ('includes/reset', 'includes/workspace-setup') THEN 1
       WHEN contains(lower(path), 'includes/') THEN 0 ELSE 2 END AS test_round,
  lower(path) NOT IN ('includes/reset', 'includes/workspace-setup') AS include_solution
FROM o WHERE NOT contains(lower(path), 'wip')""")
def path_classification(t):
    """Row 16: path rules -> test round, order (natural sorted order, with
    two pinned set-up notebooks first), solution flag; WIP paths dropped."""
    return R.classify_paths(_rel_paths_spark(t), "path", "page_id")
