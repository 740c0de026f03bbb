"""Validation suites compiled to one aggregate pass.

A suite is an ordered list of :class:`Check`.  Each check is an *aggregate*
boolean Column over the checked frame, so a whole suite runs as a single
``agg`` (partial aggregation on every executor, one tiny final merge) and the
result rows are produced by unpivoting that one row.  Dependency skipping is
resolved with Column expressions over the same row, so no second job runs.

Status semantics: a check whose expression is NULL or false has *failed*; a
check whose dependency failed or was skipped is *skipped* (and counts as
failed for later checks); default dependency is the previous check.
Points are earned only by passed checks; percentage is truncated;
a suite passes iff its percentage is 100.
"""

from __future__ import annotations

import html
from dataclasses import dataclass, field, replace

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType

from assay.functions.text import html_escape


@dataclass
class Check:
    check_id: str
    description: str
    passed: Column                      # aggregate boolean
    points: int = 1
    depends_on: list[str] | str | None = None  # None -> previous check
    hint: str | None = None
    actual: Column | None = None         # aggregate value shown in hints
    extra: dict = field(default_factory=dict)
    escape_html: bool = False            # description and hint are shown escaped
    message: str | None = None           # of the exception that evaluating the check raised
    scalar: bool = False                 # ``passed`` / ``actual`` are scalar subqueries or literals,
                                         # evaluated on the aggregated row instead of inside the agg


# ---- check constructors (one aggregate expression each) --------------------

def check_equals(check_id, actual: Column, expected, description=None, **kw) -> Check:
    return Check(check_id, description or f"{check_id} equals {expected!r}",
                 actual.eqNullSafe(F.lit(expected)), actual=actual, **kw)


def check_true(check_id, cond: Column, description=None, **kw) -> Check:
    """Every row satisfies ``cond`` (NULL is not true; empty frame passes)."""
    agg = F.coalesce(F.every(F.coalesce(cond, F.lit(False))), F.lit(True))
    return Check(check_id, description or f"{check_id} holds on every row", agg,
                 actual=F.count_if(~F.coalesce(cond, F.lit(False))), **kw)


def check_false(check_id, cond: Column, description=None, **kw) -> Check:
    """No row satisfies ``cond`` and none has it NULL."""
    agg = F.coalesce(F.every(F.coalesce(~cond, F.lit(False))), F.lit(True))
    return Check(check_id, description or f"{check_id} is false on every row", agg,
                 actual=F.count_if(F.coalesce(cond, F.lit(True))), **kw)


def check_is_none(check_id, col: Column, description=None, **kw) -> Check:
    return Check(check_id, description or f"{check_id} is null", F.count_if(col.isNotNull()) == 0,
                 actual=F.count_if(col.isNotNull()), **kw)


def check_not_none(check_id, col: Column, description=None, **kw) -> Check:
    return Check(check_id, description or f"{check_id} is not null", F.count_if(col.isNull()) == 0,
                 actual=F.count_if(col.isNull()), **kw)


def check_length(check_id, n: int, description=None, **kw) -> Check:
    return Check(check_id, description or f"{check_id} has {n} rows", F.count(F.lit(1)) == n,
                 actual=F.count(F.lit(1)), **kw)


def check_floats(check_id, actual: Column, expected, tolerance=0.01, description=None, **kw) -> Check:
    """|actual - expected| <= tolerance; both NULL passes; an uncastable value fails."""
    a = actual.try_cast("double")
    e = F.lit(expected).cast("double") if expected is not None else F.lit(None).cast("double")
    ok = F.when(actual.isNull() & e.isNull(), True).otherwise(
        F.coalesce(F.abs(a - e) <= F.lit(tolerance), F.lit(False)))
    return Check(check_id, description or f"{check_id} ~ {expected}", ok, actual=actual, **kw)


def check_contains(check_id, col: Column, values, description=None, **kw) -> Check:
    """Every value of ``col`` is in the (small, literal) domain ``values``."""
    bad = F.count_if(~F.coalesce(col.isin(list(values)), F.lit(False)))
    return Check(check_id, description or f"{check_id} in {list(values)!r}", bad == 0, actual=bad, **kw)


def check_fail(check_id, description="fail", **kw) -> Check:
    return Check(check_id, description, F.lit(False), **kw)


def check_custom(check_id, passed: Column, description=None, **kw) -> Check:
    """Any user aggregate boolean Column (the generic ``test(f, ...)``)."""
    return Check(check_id, description or check_id, passed, **kw)


# ---- checks over other frames, rows and schemas (scalar checks) -------------

def check_frames(check_id, actual: DataFrame, expected: DataFrame, mode: str = "multiset", keys=None,
                 description=None, **kw) -> Check:
    """``test_data_frames``: equal under ``mode`` (multiset / keyed / ordered,
    see :mod:`assay.operators.diff`); the verdict is a scalar subquery over
    the distributed diff, never a collect."""
    from assay.operators import diff as D
    if mode == "multiset":
        d = D.multiset_diff(actual, expected)
    elif mode == "keyed":
        d = D.keyed_diff(actual, expected, list(keys))
    else:
        d = D.ordered_diff(actual, expected, list(keys))
    n = d.agg(F.count(F.lit(1))).scalar()
    return Check(check_id, description or f"{check_id}: frames are equal ({mode})", n == 0, actual=n,
                 scalar=True, **kw)


def check_rows_match(check_id, actual: DataFrame, expected: DataFrame, keys, description=None, **kw) -> Check:
    """``test_rows`` for keyed rows: every key's rows equal as name-keyed dicts."""
    from assay.operators import diff as D
    bad = D.rows_equal(actual, expected, list(keys)).agg(F.count_if(~F.col("rows_equal"))).scalar()
    return Check(check_id, description or f"{check_id}: rows are equal", bad == 0, actual=bad, scalar=True, **kw)


def check_schema_field(check_id, df: DataFrame, name: str, type_name: str, nullable: bool | None = None,
                       description=None, **kw) -> Check:
    """``test_schema_field``: the field exists with the Spark type class name
    (and nullability when asked).  Schema metadata only."""
    f = next((x for x in df.schema.fields if x.name == name), None)
    tname = None if f is None else type(f.dataType).__name__
    ok = f is not None and tname == type_name and (nullable is None or f.nullable == nullable)
    found = None if f is None else (f"{f.name}, {tname}, {f.nullable}" if nullable is None else f"{f.name}, {tname}")
    desc = description or (f'Schema contains "{name}" of type {type_name}' if nullable is None
                           else f'Schema contains "{name}" of type {type_name} (nullable={nullable})')
    kw.setdefault("hint", "Found [[ACTUAL_VALUE]]")
    return Check(check_id, desc, F.lit(ok), actual=F.lit(found).cast("string"), scalar=True, **kw)


def check_list(check_id, values: DataFrame, column: str, expected: list, ordered: bool = False,
               order_by: str | None = None, description=None, **kw) -> Check:
    """``test_sequence``: the values of ``column`` against an expected list.
    Unordered: equal length and membership both ways (not a multiset, as in
    the reference); ordered: equal at every position of ``order_by``."""
    exp = values.sparkSession.createDataFrame([(i, v) for i, v in enumerate(expected)], f"pos int, v string")
    vals = values.select(F.col(column).cast("string").alias("v"), *([order_by] if order_by else []))
    n = vals.agg(F.count(F.lit(1))).scalar()
    if ordered:
        from assay.operators.ordering import with_row_index
        idx = with_row_index(vals, [order_by], "pos").select(F.col("pos").cast("int").alias("pos"), "v")
        j = idx.join(exp.withColumnRenamed("v", "e"), "pos", "full_outer")
        bad = j.agg(F.count_if(~F.col("v").eqNullSafe(F.col("e")))).scalar()
        ok = bad == 0
    else:
        da, de = vals.select("v").distinct(), exp.select("v").distinct()
        miss = (da.join(de, "v", "left_anti").agg(F.count(F.lit(1))).scalar()
                + de.join(da, "v", "left_anti").agg(F.count(F.lit(1))).scalar())
        ok = (n == len(expected)) & (miss == 0)
    return Check(check_id, description or f"{check_id}: sequence matches", ok, actual=n, scalar=True, **kw)


class Suite:
    """Builder with the reference's method names; ``run(df)`` compiles the
    suite into one aggregate pass over ``df`` (frame checks as scalar
    subqueries)."""

    def __init__(self, name: str):
        self.name = name
        self.checks: list[Check] = []
        self._n = 0

    def _add(self, c: Check) -> "Suite":
        self.checks.append(c)
        return self

    def _id(self, test_case_id):
        if test_case_id is None:
            self._n += 1
            return str(self._n)
        return test_case_id

    def test(self, passed: Column, description: str, *, test_case_id=None, **kw):
        return self._add(check_custom(self._id(test_case_id), passed, description, **kw))

    def test_equals(self, actual: Column, expected, description: str, *, test_case_id=None, **kw):
        return self._add(check_equals(self._id(test_case_id), actual, expected, description, **kw))

    def test_true(self, cond: Column, description: str, *, test_case_id=None, **kw):
        return self._add(check_true(self._id(test_case_id), cond, description, **kw))

    def test_false(self, cond: Column, description: str, *, test_case_id=None, **kw):
        return self._add(check_false(self._id(test_case_id), cond, description, **kw))

    def test_is_none(self, col: Column, description: str, *, test_case_id=None, **kw):
        return self._add(check_is_none(self._id(test_case_id), col, description, **kw))

    def test_not_none(self, col: Column, description: str, *, test_case_id=None, **kw):
        return self._add(check_not_none(self._id(test_case_id), col, description, **kw))

    def test_length(self, n: int, description: str, *, test_case_id=None, **kw):
        return self._add(check_length(self._id(test_case_id), n, description, **kw))

    def test_floats(self, actual: Column, expected, description: str, *, test_case_id=None, tolerance=0.01, **kw):
        return self._add(check_floats(self._id(test_case_id), actual, expected, tolerance, description, **kw))

    def test_contains(self, col: Column, values, description: str, *, test_case_id=None, **kw):
        return self._add(check_contains(self._id(test_case_id), col, values, description, **kw))

    def test_data_frames(self, actual: DataFrame, expected: DataFrame, description: str, *, test_case_id=None,
                         mode="multiset", keys=None, **kw):
        return self._add(check_frames(self._id(test_case_id), actual, expected, mode, keys, description, **kw))

    def test_rows(self, actual: DataFrame, expected: DataFrame, keys, description: str, *, test_case_id=None, **kw):
        return self._add(check_rows_match(self._id(test_case_id), actual, expected, keys, description, **kw))

    def test_schema_field(self, df: DataFrame, name: str, type_name: str, nullable=None, *, description=None,
                          test_case_id=None, **kw):
        return self._add(check_schema_field(self._id(test_case_id), df, name, type_name, nullable, description, **kw))

    def test_sequence(self, values: DataFrame, column: str, expected: list, test_column_order: bool,
                      description: str, *, order_by=None, test_case_id=None, **kw):
        return self._add(check_list(self._id(test_case_id), values, column, expected, test_column_order, order_by,
                                    description, **kw))

    def test_vectorised(self, df: DataFrame, fn, columns: list[str], description: str, *, test_case_id=None, **kw):
        """A Python function of whole column batches (pandas Series in, boolean Series out)."""
        from assay.operators.vectorised import check_vectorised
        return self._add(check_vectorised(self._id(test_case_id), df, fn, columns, description, **kw))

    def fail(self, description: str, *, test_case_id=None, **kw):
        return self._add(check_fail(self._id(test_case_id), description, **kw))

    def fail_pre_req(self, *, test_case_id, e: Exception, depends_on=None):
        return self.fail(f"Execute prerequisites. {e}", test_case_id=test_case_id, depends_on=depends_on)

    def run(self, df: DataFrame, isolated: bool = False) -> DataFrame:
        """The result rows.  ``isolated``: a check that raises fails alone,
        with its exception as ``message``, and others are not affected; the
        checks are then evaluated once beforehand."""
        checks = isolate(df, self.checks) if isolated else self.checks
        return run_suite(df, checks, suite=self.name)


# ---- compilation -------------------------------------------------------------

def _resolve_deps(suite: str, checks: list[Check]) -> list[list[int]]:
    ids = {}
    deps = []
    for i, c in enumerate(checks):
        key = c.check_id
        if key in ids:
            raise ValueError(f"Duplicate test case id: {key}")
        if c.depends_on is None:
            d = [i - 1] if i > 0 else []
        else:
            d = []
            for dep in [c.depends_on] if isinstance(c.depends_on, str) else c.depends_on:
                # accept both bare ids and suite-prefixed ids
                dep = dep[len(suite) + 1:] if dep.startswith(suite + "-") else dep
                if dep in ids:
                    d.append(ids[dep])
        ids[key] = i
        deps.append(d)
    return deps


def isolate(df: DataFrame, checks: list[Check]) -> list[Check]:
    """The checks with each one that raises replaced by a failed check that
    carries the exception's text as ``message``.

    All are evaluated in one job; only if that raises is each half evaluated by
    itself, and so on, to find those at fault.  Nothing but booleans reaches the driver."""
    def evaluate(some: list[Check]) -> None:
        run_suite(df, [replace(c, depends_on=[]) for c in some]).select("status").collect()

    def told(e: Exception) -> str:
        return str(e).strip().split("\n")[0]

    def sound(some: list[Check]) -> list[Check]:
        try:
            evaluate(some)
            return some
        except PySparkException as e:
            if len(some) > 1:
                half = len(some) // 2
                return sound(some[:half]) + sound(some[half:])
            failed = replace(some[0], passed=F.lit(False), scalar=True, message=told(e))
            return [failed if failed.actual is None else replace(failed, actual=F.lit("actual_value() call failed"))]

    return sound(checks) if checks else checks


def run_suite(df: DataFrame, checks: list[Check], suite: str = "suite",
              extra: dict[str, Column] | None = None, by: Column | None = None) -> DataFrame:
    """One aggregate pass over ``df`` -> one result row per check, or for each
    group of ``by`` one row per check (``extra`` aggregates tell groups apart).

    Columns: suite, seq, check_id, description, status, passed, points,
    max_points, hint, (message, if a check raised when isolated,) score, max_score, percentage, suite_passed, plus any
    ``extra`` aggregates computed in the same pass.  Statuses,
    score and percentage are computed on the aggregated row before it
    is unpivoted, so the checked frame is scanned exactly once.
    """
    deps = _resolve_deps(suite, checks)
    if not checks:
        spark = df.sparkSession
        return spark.createDataFrame([], "seq int, check_id string, description string, status string, "
                                         "max_points int, hint string, suite string, passed boolean, points int, "
                                         "score bigint, max_score bigint, percentage int, suite_passed boolean")
    aggs = []
    for i, c in enumerate(checks):
        if c.scalar:
            continue
        aggs.append(c.passed.alias(f"_ok{i}"))
        if c.hint is not None and c.actual is not None:
            aggs.append(c.actual.alias(f"_act{i}"))
    extra = extra or {}
    aggs += [c.alias(k) for k, c in extra.items()]
    one = (df if by is None else df.groupBy(by.alias("_by"))).agg(*(aggs or [F.count(F.lit(1)).alias("_rows")]))
    # frame-, row- and schema-level checks: scalar subqueries on the one row
    for i, c in enumerate(checks):
        if c.scalar:
            one = one.withColumn(f"_ok{i}", c.passed)
            if c.hint is not None and c.actual is not None:
                one = one.withColumn(f"_act{i}", c.actual)
    # failure / skip flags composed in check order over the single row
    for i, c in enumerate(checks):
        ok = F.coalesce(F.col(f"_ok{i}"), F.lit(False))
        skipped = F.lit(False)
        for d in deps[i]:
            skipped = skipped | F.col(f"_failed{d}")
        one = (one.withColumn(f"_skip{i}", skipped)
                  .withColumn(f"_failed{i}", F.col(f"_skip{i}") | ~ok)
                  .withColumn(f"_st{i}", F.when(F.col(f"_skip{i}"), "skipped").when(ok, "passed").otherwise("failed")))
    score = sum((F.when(F.col(f"_st{i}") == "passed", F.lit(int(c.points))).otherwise(F.lit(0))
                 for i, c in enumerate(checks)), F.lit(0))
    max_score = sum(int(c.points) for c in checks)
    pct = (F.lit(0) if max_score == 0 else F.floor(F.lit(100.0) * F.col("score") / F.lit(max_score))).cast("int")
    one = (one.withColumn("score", score.cast("bigint")).withColumn("max_score", F.lit(max_score).cast("bigint"))
              .withColumn("percentage", pct))
    rows = []
    kinds = {f.name: f.dataType for f in one.schema.fields}
    any_message = any(c.message is not None for c in checks)
    for i, c in enumerate(checks):
        status = F.col(f"_st{i}")
        hint = F.lit(None).cast("string")
        if c.hint is not None:
            h = F.lit(c.hint)
            if c.actual is not None:
                raw, kind = F.col(f"_act{i}"), kinds[f"_act{i}"]
                act = html_escape(F.coalesce(raw.cast("string"), F.lit("None")))
                # the length of what has one, else the value itself
                size = (F.length(raw) if isinstance(kind, (StringType, BinaryType)) else
                        F.size(raw) if isinstance(kind, (ArrayType, MapType)) else F.lit(None))
                h = F.replace(h, F.lit("[[ACTUAL_VALUE]]"), act)
                h = F.replace(h, F.lit("[[LEN_ACTUAL_VALUE]]"), F.coalesce(F.when(raw.isNotNull(), size).cast("string"), act))
            if c.escape_html:
                h = html_escape(h)
            hint = F.when(status == "failed", h)
        rows.append(F.struct(
            F.lit(i + 1).alias("seq"),
            F.lit(c.check_id).alias("check_id"),
            F.lit(html.escape(c.description) if c.escape_html else c.description).alias("description"),
            status.alias("status"),
            F.lit(int(c.points)).alias("max_points"),
            hint.alias("hint"),
            *[F.lit(c.message or "").alias("message")] * any_message,
        ))
    exploded = one.select(F.inline(F.array(*rows)), "score", "max_score", "percentage", *extra.keys())
    return (exploded
            .withColumn("suite", F.lit(suite))
            .withColumn("passed", F.col("status") == "passed")
            .withColumn("points", F.when(F.col("passed"), F.col("max_points")).otherwise(F.lit(0)))
            .withColumn("suite_passed", F.col("percentage") == 100))


def summarize(results: DataFrame, suite_col: str = "suite") -> DataFrame:
    """Attach score, max_score, percentage (truncated), suite_passed.

    ``results`` is a result table (one row per check), tiny compared with the
    checked data, so a grouped aggregate joined back is cheap; it is written
    as aggregate + join rather than a window so a huge suite is not sorted.
    """
    tot = (results.groupBy(suite_col)
           .agg(F.sum("points").cast("bigint").alias("score"),
                F.sum("max_points").cast("bigint").alias("max_score")))
    tot = (tot.withColumn("percentage",
                          F.when(F.col("max_score") == 0, F.lit(0))
                          .otherwise(F.floor(F.lit(100.0) * F.col("score") / F.col("max_score")))
                          .cast("int"))
           .withColumn("suite_passed", F.col("percentage") == 100))
    return results.join(tot, suite_col, "left")


def latest_results(results: DataFrame, suite: str, check: str, passed: Column, order: list[str]) -> DataFrame:
    """The cross-suite aggregator: per (suite, check) the last result by
    ``order`` wins (``max_by``, partially aggregated), then per suite the
    number of checks, the score, truncated percentage and verdict."""
    latest = results.groupBy(suite, check).agg(F.max_by(passed, F.struct(*order)).alias("_ok"))
    g = latest.groupBy(suite).agg(F.count(F.lit(1)).alias("n_checks"), F.count_if("_ok").alias("score"))
    pct = F.floor(F.lit(100.0) * F.col("score") / F.col("n_checks")).cast("int")
    return g.select(suite, "n_checks", "score", F.col("n_checks").alias("max_score"), pct.alias("percentage"),
                    (pct == 100).alias("passed"))
