"""Report and audit operators over run logs, job runs, ACLs, users and
paths.  Every function takes the caller's DataFrames and column names and
returns a DataFrame; predicates are Columns, so everything stays in Catalyst.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.ordering import with_row_index

col = F.col

# The run states with their own report section, in order.
SECTIONS = ["FAILED", "IGNORED", "SUCCESS"]


def run_sections(runs: DataFrame, suite: str, state: str) -> DataFrame:
    """Per suite the FAILED / IGNORED / SUCCESS counts, any other state in
    ``other``; a suite passed iff it has no FAILED run.  One grouped pass."""
    st = col(state)
    return runs.groupBy(suite).agg(
        *[F.count_if(st == s).alias(s.lower()) for s in SECTIONS],
        F.count_if(~st.isin(*SECTIONS)).alias("other"),
        (F.count_if(st == "FAILED") == 0).alias("passed"))


def normalized_state(result_state: Column, ignore_failures: Column) -> Column:
    """Absent result -> UNKNOWN; FAILED of a test told to ignore failures -> IGNORED."""
    rs = F.coalesce(result_state, F.lit("UNKNOWN"))
    return F.when((rs == "FAILED") & ignore_failures, F.lit("IGNORED")).otherwise(rs)


def report_order(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Report rows numbered in ``order`` without a single-task sort."""
    return with_row_index(df, order, name)


def cleanup_eligible(jobs: DataFrame, runs: DataFrame, job: str, life_cycle: str, result: str,
                     success_only: bool = True) -> DataFrame:
    """A job may be deleted when all its runs are TERMINATED and SUCCESS
    (any run, when not ``success_only``); a job with no run is eligible."""
    ok = (col(life_cycle) == "TERMINATED") & F.coalesce(col(result) == "SUCCESS", F.lit(False))
    if not success_only:
        ok = F.lit(True)
    g = runs.groupBy(job).agg(F.count(F.lit(1)).alias("n_runs"), F.every(ok).alias("_ok"))
    j = jobs.select(job).join(g, job, "left")
    return j.select(job, F.coalesce("n_runs", F.lit(0).cast("bigint")).alias("n_runs"),
                    F.coalesce("_ok", F.lit(True)).alias("eligible"))


def ambiguous(df: DataFrame, name: str, key: str) -> DataFrame:
    """Names that resolve to more than one record: count and key range."""
    return (df.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_id"),
                                 F.max(key).alias("last_id")).where(col("n") > 1))


def severity_label(warnings: Column, errors: Column, exceptions: Column) -> Column:
    def part(n, word):
        return F.when(n > 0, F.concat(F.lit(" "), n.cast("string"), F.lit(f" {word} |"))).otherwise(F.lit(""))
    return F.concat(F.lit("| "), F.trim(F.concat(part(exceptions, "Exceptions"), part(errors, "Errors"),
                                                 part(warnings, "Warnings"))))


def severity_rollup(events: DataFrame, thread: str, warning: Column, error: Column, exception: Column,
                    thread_alias: str = "thread") -> DataFrame:
    """Per thread the counts, the label of the non-zero ones and the colour
    (danger on any error or exception, else warning)."""
    c = events.groupBy(col(thread).alias(thread_alias)).agg(
        F.count_if(warning).alias("warnings"), F.count_if(error).alias("errors"),
        F.count_if(exception).alias("exceptions"))
    return c.select(thread_alias, "warnings", "errors", "exceptions",
                    severity_label(col("warnings"), col("errors"), col("exceptions")).alias("label"),
                    F.when((col("errors") > 0) | (col("exceptions") > 0), "danger").otherwise("warning").alias("color"))


def completeness(users: DataFrame, files: DataFrame, user: str) -> DataFrame:
    """Per user the file count against the first user's (lowest key) count:
    'extra files found', 'half imported', or 'missing' (no files at all);
    users matching the baseline are not reported.  The baseline is a scalar
    subquery (one value)."""
    c = files.groupBy(user).agg(F.count(F.lit(1)).alias("file_count"))
    base = c.agg(F.min_by("file_count", user)).scalar()
    j = users.select(user).join(c, user, "left").withColumn("baseline", base)
    status = (F.when(col("file_count").isNull(), "missing").when(col("file_count") > col("baseline"), "extra files found")
              .otherwise("half imported"))
    return (j.where(col("file_count").isNull() | (col("file_count") != col("baseline")))
            .select(user, "file_count", "baseline", status.alias("status")))


def required_groups_gate(required: list[str], df: DataFrame, group: str, passed: Column) -> DataFrame:
    """Each required group: present, passing (every row), and the overall gate."""
    spark = df.sparkSession
    req = spark.createDataFrame([(g,) for g in required], "grp string")
    g = df.groupBy(col(group).alias("grp")).agg(F.every(passed).alias("passed"))
    j = req.join(g.withColumn("_p", F.lit(True)), "grp", "left").select(
        "grp", col("_p").isNotNull().alias("present"), F.coalesce("passed", F.lit(False)).alias("passed"))
    return j.withColumn("gate", j.agg(F.every(col("present") & col("passed"))).scalar())


def pattern_counts(df: DataFrame, by: list[str], patterns: dict[str, Column]) -> DataFrame:
    """Counts of rows matching each named predicate, per group."""
    return df.groupBy(*by).agg(*[F.count_if(p).alias(n) for n, p in patterns.items()])


def flatten_acl(df: DataFrame, obj: str, acl: str = "access_control_list") -> DataFrame:
    """Nested ACL -> (object, principal_type, principal, permission_level) for
    permissions that are not inherited (an absent flag is not): explode
    entries, each principal that an entry names, and permissions."""
    a = df.select(obj, F.explode(acl).alias("e"))
    named = F.filter(F.array(*[F.struct(F.lit(kind).alias("principal_type"), col(f"e.{field}").alias("principal")) for kind, field in
                               (("user", "user_name"), ("group", "group_name"), ("service_principal", "service_principal_name"))]),
                     lambda k: k["principal"].isNotNull())
    p = a.select(obj, F.explode(named).alias("k"), col("e.all_permissions").alias("ps")).select(obj, "k", F.explode("ps").alias("p"))
    return (p.where(~F.coalesce(col("p.inherited"), F.lit(False)))
            .select(obj, col("k.principal_type").alias("principal_type"), col("k.principal").alias("principal"),
                    col("p.permission_level").alias("permission_level")))


def holders_outside(users: DataFrame, entitlement: str, group: str, entitlements: str = "entitlements",
                    groups: str = "groups") -> DataFrame:
    """Users who hold ``entitlement`` and are not in ``group``; absent arrays
    and names count as empty."""
    has = F.exists(F.coalesce(entitlements, F.array()), lambda e: e["value"].eqNullSafe(F.lit(entitlement)))
    inside = F.exists(F.coalesce(groups, F.array()), lambda g: g["display"].eqNullSafe(F.lit(group)))
    return users.where(has & ~inside)


def resolve_owners(flat: DataFrame, objects: DataFrame, obj: str) -> DataFrame:
    """Owner of each object (IS_OWNER principals); ambiguous unless exactly one."""
    o = flat.where(col("permission_level") == "IS_OWNER").groupBy(obj).agg(
        F.array_sort(F.collect_set("principal")).alias("owners"))
    j = objects.select(obj).join(o, obj, "left")
    n = F.when(col("owners").isNull(), F.lit(0)).otherwise(F.size("owners"))
    return j.select(obj, n.cast("int").alias("n_owners"),
                    F.when(n == 1, F.try_element_at("owners", F.lit(1))).alias("owner"), (n != 1).alias("ambiguous"))


def stale(entities: DataFrame, updates: DataFrame, key: str, ts: str, flag: Column, now: Column,
          minutes: int = 30) -> DataFrame:
    """Flagged entities whose last update is missing or older than ``minutes``
    before ``now`` (a parameter, never the wall clock)."""
    u = updates.groupBy(key).agg(F.max(ts).alias("last_update"))
    j = entities.select(key, flag.alias("_flag")).join(u, key, "left")
    mins = F.floor(F.timestamp_diff("MICROSECOND", col("last_update"), now) / 60_000_000).cast("bigint")
    old = col("last_update").isNull() | (col("last_update") < now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return j.where(col("_flag") & old).select(key, "last_update", mins.alias("minutes_since"))


def union_pages(pages: DataFrame, body: str, item_schema: str, keys: list[str], cols: list[str]) -> DataFrame:
    """Landed result pages (JSON arrays) read back, exploded and de-duplicated on the item id."""
    landed = pages.select(*keys, F.explode(F.from_json(body, f"array<struct<{item_schema}>>")).alias("i"))
    return landed.select(*keys, *[col(f"i.{c}").alias(c) for c in cols]).distinct()


def filter_runs(runs: DataFrame, *, job: str, job_id=None, state: str | None = None, states=None,
                ts: str | None = None, start=None, end=None, order=None, offset: int = 0,
                limit: int | None = None) -> DataFrame:
    """Run filters: job, states, time range, then newest-first paging."""
    cond = F.lit(True)
    if job_id is not None:
        cond = cond & (col(job) == job_id)
    if states:
        cond = cond & col(state).isin(list(states))
    if start is not None:
        cond = cond & (col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        cond = cond & (col(ts) < F.lit(end).cast("timestamp_ntz"))
    out = runs.where(cond)
    if order:
        out = out.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(limit) if limit is not None else out


def entitlement_changes(df: DataFrame, key: str, wanted: Column) -> DataFrame:
    """A map entitlement -> wanted (true add, false remove, null skip) to
    sorted add and remove lists, per row (no shuffle)."""
    adds = F.array_join(F.array_sort(F.map_keys(F.map_filter(wanted, lambda k, v: F.coalesce(v, F.lit(False))))), ",")
    rem = F.array_join(F.array_sort(F.map_keys(F.map_filter(wanted, lambda k, v: F.coalesce(~v, F.lit(False))))), ",")
    return df.select(key, adds.alias("adds"), rem.alias("removes"))


def name_part_match(df: DataFrame, key: str, name: Column, prefixes: list[str], sep: str = "_") -> DataFrame:
    """Names whose ``sep``-separated parts equal, or start with, one of the prefixes; each name once."""
    parts = F.split(name, sep)
    exact = F.exists(parts, lambda x: x.isin(prefixes))
    pref = F.exists(parts, lambda x: reduce(lambda a, b: a | b, [x.startswith(s) for s in prefixes]))
    return df.select(key, name.alias("name"), exact.alias("exact_match"), pref.alias("prefix_match")).distinct()


def union_sources(frames: dict[str, DataFrame], lead: list[str], errors: dict[str, str] | None = None) -> DataFrame:
    """Heterogeneous per-source records merged by column name (missing
    columns NULL), a ``source`` column, fixed lead columns first, and one
    error row per failed source."""
    out = None
    for name, df in frames.items():
        d = df.select(F.lit(name).alias("source"), *df.columns)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    out = out.withColumn("error", F.lit(None).cast("string"))
    if errors:
        spark = out.sparkSession
        err = spark.createDataFrame(list(errors.items()), "source string, error string")
        out = out.unionByName(err, allowMissingColumns=True)
    rest = [c for c in out.columns if c not in ["source", *lead, "error"]]
    return out.select("source", *lead, *rest, "error")


def uptime_hours(start: Column, now: Column) -> Column:
    """Hours since ``start`` at ``now``, one decimal (time-zone independent)."""
    return F.round(F.timestamp_diff("MICROSECOND", start, now) / 1000 / 3600000.0, 1)


# The contract error codes.
E_NOT_NONE, E_TYPE, E_MIN_L, E_MIN_V = "Error-Not-None", "Error-Type", "Error-Min-Len", "Error-Min-Value"


def column_contract(df: DataFrame, contract) -> DataFrame:
    """(column, type, min_length, min_value, non_none) rules checked over
    whole columns in one aggregate pass: one count per (column, error code)."""
    aggs, labels = [], []
    types = dict(df.dtypes)
    for name, typ, min_len, min_val, non_none in contract:
        c = col(name)
        if non_none or min_len is not None:
            aggs.append(F.count_if(c.isNull()))
            labels.append((name, E_NOT_NONE))
        if types[name] != typ:
            aggs.append(F.count_if(c.isNotNull() & c.try_cast(typ).isNull()))
            labels.append((name, E_TYPE))
        if min_len is not None:
            aggs.append(F.count_if(F.length(c) < min_len))
            labels.append((name, E_MIN_L))
        if min_val is not None:
            aggs.append(F.count_if(c < min_val))
            labels.append((name, E_MIN_V))
    one = df.agg(*[a.alias(f"_v{i}") for i, a in enumerate(aggs)])
    rows = [F.struct(F.lit(n).alias("column_name"), F.lit(e).alias("error_code"), col(f"_v{i}").alias("violations"))
            for i, (n, e) in enumerate(labels)]
    return one.select(F.inline(F.array(*rows)))


def select_allowed(df: DataFrame, allowed: list[str]) -> DataFrame:
    """Only the allow-listed columns that exist (pruning reaches the scan)."""
    return df.select(*[c for c in df.columns if c in allowed])


def list_partition_audit(values: DataFrame, value: str, include: list[str], exclude: list[str]) -> DataFrame:
    """Include / exclude lists must be disjoint, name existing values and
    cover all of them: one row per problem ('unknown', 'both', 'neither')."""
    spark = values.sparkSession
    b = values.select(col(value).alias("v")).distinct().withColumn("_b", F.lit(True))
    i = spark.createDataFrame([(x,) for x in include], "v string").withColumn("_i", F.lit(True))
    e = spark.createDataFrame([(x,) for x in exclude], "v string").withColumn("_e", F.lit(True))
    j = b.join(i, "v", "full_outer").join(e, "v", "full_outer")
    inc, exc, ex = col("_i").isNotNull(), col("_e").isNotNull(), col("_b").isNotNull()
    problem = F.when(~ex, "unknown").when(inc & exc, "both").when(~inc & ~exc, "neither")
    return (j.select(col("v").alias(value), inc.alias("included"), exc.alias("excluded"), ex.alias("exists_"),
                     problem.alias("problem")).where(col("problem").isNotNull()))


def tag_by_predicates(df: DataFrame, exclude: Column, ignore: Column, round_pred: Column, round_no: int,
                      default_round: int = 2) -> DataFrame:
    """Caller predicates as Columns: exclusion, ignore-failures flag, test round."""
    return (df.where(~exclude).withColumn("ignored", ignore)
            .withColumn("test_round", F.when(round_pred, F.lit(round_no)).otherwise(F.lit(default_round))))


# The two set-up notebooks that run first, in this order.
PINNED = ["includes/reset", "includes/workspace-setup"]


def classify_paths(df: DataFrame, path: str, tie: str) -> DataFrame:
    """Natural (sorted) order, test round (includes -> 0, pinned set-up
    notebooks -> 1, else 2), solution flag; work-in-progress paths dropped
    after numbering."""
    o = with_row_index(df, [path, tie], "nat")
    lp = F.lower(col(path))
    pinned = lp.isin(*PINNED)
    order = F.when(lp == PINNED[0], 0).when(lp == PINNED[1], 1).otherwise(col("nat"))
    rnd = F.when(pinned, 1).when(lp.contains("includes/"), 0).otherwise(2)
    return (o.where(~lp.contains("wip"))
            .select(tie, path, order.cast("bigint").alias("notebook_order"), rnd.alias("test_round"),
                    (~pinned).alias("include_solution")))


def latest_run_verdict(jobs: DataFrame, runs: DataFrame, job: str, order: list[str], life_cycle: str,
                       result: str) -> DataFrame:
    """Latest run per job (``max_by`` on ``order``) with its verdict; jobs
    without runs are reported as NO_RUNS (left join from the job list)."""
    o = F.struct(*order)
    latest = runs.groupBy(job).agg(F.max_by(life_cycle, o).alias(life_cycle), F.max_by(result, o).alias(result),
                                   F.count(F.lit(1)).alias("n_runs"))
    j = jobs.select(job).join(latest.withColumn("_has", F.lit(True)), job, "left")
    verdict = (F.when(col("_has").isNull(), "NO_RUNS").when(col(life_cycle) != "TERMINATED", "PENDING")
               .when(col(result) == "SUCCESS", "OK").otherwise("FAILED"))
    return j.select(job, F.coalesce(col("n_runs"), F.lit(0).cast("bigint")).alias("n_runs"), life_cycle, result,
                    verdict.alias("verdict"))
