"""Family V queries: check suites as one-pass scorecards."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import checks as C
from assay.operators import vectorised as V
from assay.plans.registry import query


def lineitem_suite(t):
    """Ten constraints on lineitem joined to its orders."""
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag",
                           "l_linestatus", "l_extendedprice", "l_shipdate")
    od = t.orders.select("o_orderkey", "o_orderdate")
    df = li.join(od, li.l_orderkey == od.o_orderkey, "left")
    col = F.col
    return df, [
        C.check_not_none("orderkey_not_null", col("l_orderkey")),
        C.check_true("quantity_range", col("l_quantity").between(1, 50)),
        C.check_true("discount_range", col("l_discount").between(0.0, 0.1)),
        C.check_contains("returnflag_domain", col("l_returnflag"), ["A", "N", "R"]),
        C.check_contains("linestatus_domain", col("l_linestatus"), ["O", "F"]),
        C.check_floats("avg_discount", F.avg("l_discount"), 0.05, tolerance=0.01),
        C.check_custom("orders_exist", F.count_if(col("o_orderkey").isNull()) == 0,
                       "every line has its order"),
        C.check_true("ship_after_order", col("l_shipdate") >= col("o_orderdate"),
                     hint="[[ACTUAL_VALUE]] lines ship before their order"),
        C.check_true("tax_range", col("l_tax").between(0.0, 0.08)),
        C.check_true("price_positive", col("l_extendedprice") > 0, points=2,
                     depends_on=["orders_exist"]),
    ]


SCORECARD_SQL = """
WITH j AS (
  SELECT l.*, o.o_orderkey, o.o_orderdate
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
), a AS (
  SELECT
    count_if(l_orderkey IS NULL) = 0 AS ok1,
    coalesce(bool_and(coalesce(l_quantity BETWEEN 1 AND 50, false)), true) AS ok2,
    coalesce(bool_and(coalesce(l_discount BETWEEN 0.0 AND 0.1, false)), true) AS ok3,
    count_if(NOT coalesce(l_returnflag IN ('A','N','R'), false)) = 0 AS ok4,
    count_if(NOT coalesce(l_linestatus IN ('O','F'), false)) = 0 AS ok5,
    coalesce(abs(avg(l_discount) - 0.05) <= 0.01, false) AS ok6,
    count_if(o_orderkey IS NULL) = 0 AS ok7,
    coalesce(bool_and(coalesce(l_shipdate >= o_orderdate, false)), true) AS ok8,
    CAST(count_if(NOT coalesce(l_shipdate >= o_orderdate, false)) AS VARCHAR) AS act8,
    coalesce(bool_and(coalesce(l_tax BETWEEN 0.0 AND 0.08, false)), true) AS ok9,
    coalesce(bool_and(coalesce(l_extendedprice > 0, false)), true) AS ok10
  FROM j
), r AS (
  SELECT * FROM (VALUES
    (1, 'orderkey_not_null', 'orderkey_not_null is not null', 1, 0),
    (2, 'quantity_range', 'quantity_range holds on every row', 1, 1),
    (3, 'discount_range', 'discount_range holds on every row', 1, 2),
    (4, 'returnflag_domain', 'returnflag_domain in [''A'', ''N'', ''R'']', 1, 3),
    (5, 'linestatus_domain', 'linestatus_domain in [''O'', ''F'']', 1, 4),
    (6, 'avg_discount', 'avg_discount ~ 0.05', 1, 5),
    (7, 'orders_exist', 'every line has its order', 1, 6),
    (8, 'ship_after_order', 'ship_after_order holds on every row', 1, 7),
    (9, 'tax_range', 'tax_range holds on every row', 1, 8),
    (10, 'price_positive', 'price_positive holds on every row', 2, 7)
  ) v(seq, check_id, description, max_points, dep_seq)
), raw AS (
  SELECT r.*, CASE seq WHEN 1 THEN ok1 WHEN 2 THEN ok2 WHEN 3 THEN ok3 WHEN 4 THEN ok4
                       WHEN 5 THEN ok5 WHEN 6 THEN ok6 WHEN 7 THEN ok7 WHEN 8 THEN ok8
                       WHEN 9 THEN ok9 ELSE ok10 END AS ok, a.act8
  FROM r, a
), st AS (
  SELECT raw.*,
    EXISTS (SELECT 1 FROM raw r2 WHERE r2.seq <= raw.dep_seq AND NOT coalesce(r2.ok, false)) AS skipped
  FROM raw
), res AS (
  SELECT 'lineitem' AS suite, CAST(seq AS INTEGER) AS seq, check_id, description,
    CASE WHEN skipped THEN 'skipped' WHEN ok THEN 'passed' ELSE 'failed' END AS status,
    CAST(max_points AS INTEGER) AS max_points,
    CASE WHEN NOT skipped AND NOT ok AND seq = 8
         THEN replace('[[ACTUAL_VALUE]] lines ship before their order', '[[ACTUAL_VALUE]]', act8) END AS hint,
    (NOT skipped AND ok) AS passed
  FROM st
), res2 AS (
  SELECT *, CAST(CASE WHEN passed THEN max_points ELSE 0 END AS INTEGER) AS points FROM res
), tot AS (
  SELECT suite, CAST(sum(points) AS BIGINT) AS score, CAST(sum(max_points) AS BIGINT) AS max_score FROM res2 GROUP BY suite
)
SELECT res2.*, tot.score, tot.max_score,
  CAST(CASE WHEN max_score = 0 THEN 0 ELSE floor(100.0 * score / max_score) END AS INTEGER) AS percentage,
  CAST(CASE WHEN max_score = 0 THEN 0 ELSE floor(100.0 * score / max_score) END AS INTEGER) = 100 AS suite_passed
FROM res2 JOIN tot USING (suite)
"""


@query("scorecard", SCORECARD_SQL)
def scorecard(t):
    """Which of ten lineitem constraints hold, which are skipped behind a
    failure, and the suite score (rows 32, 44, 79, 89-94, 100, 101)."""
    df, checks = lineitem_suite(t)
    return C.run_suite(df, checks, suite="lineitem")


# ---- one suite per check kind (rows 86-96) ---------------------------------

from assay.plans.sqlkit import Spec, suite_sql, to_checks  # noqa: E402

col = F.col


def _suite_query(name, suite, table_sql, frame, specs, doc):
    def fn(t):
        return C.run_suite(frame(t), to_checks(specs), suite=suite)
    fn.__doc__ = doc
    query(name, suite_sql(table_sql, suite, specs))(fn)


_EQ = [
    Spec("returnflags", "three return flags", lambda: F.count_distinct("l_returnflag") == 3,
         "count(DISTINCT l_returnflag) = 3"),
    Spec("max_line", "at most seven lines per order", lambda: F.max("l_linenumber").eqNullSafe(F.lit(7)),
         "max(l_linenumber) IS NOT DISTINCT FROM 7"),
    Spec("min_qty", "smallest quantity is 1", lambda: F.min("l_quantity").eqNullSafe(F.lit(1.0)),
         "min(l_quantity) IS NOT DISTINCT FROM 1.0"),
    Spec("max_line_8", "eight lines somewhere", lambda: F.max("l_linenumber").eqNullSafe(F.lit(8)),
         "max(l_linenumber) IS NOT DISTINCT FROM 8", hint="max is [[ACTUAL_VALUE]]",
         spark_actual=lambda: F.max("l_linenumber"), sql_actual="max(l_linenumber)"),
    Spec("statuses", "two line statuses", lambda: F.count_distinct("l_linestatus") == 2,
         "count(DISTINCT l_linestatus) = 2", depends_on=["returnflags"]),
]
_suite_query("check_equals", "equals", "SELECT * FROM lineitem", lambda t: t.lineitem, _EQ,
             "Row 89: test_equals over lineitem aggregates.")

_BOOL = [
    Spec("tax_nonneg", "tax is never negative", lambda: F.coalesce(F.every(F.coalesce(col("l_tax") >= 0, F.lit(False))), F.lit(True)),
         "coalesce(bool_and(coalesce(l_tax >= 0, false)), true)"),
    Spec("no_big_qty", "no quantity above 50", lambda: F.coalesce(F.every(F.coalesce(~(col("l_quantity") > 50), F.lit(False))), F.lit(True)),
         "coalesce(bool_and(coalesce(NOT (l_quantity > 50), false)), true)"),
    Spec("shipped_before_2000", "all shipped before 2000",
         lambda: F.coalesce(F.every(F.coalesce(col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(False))), F.lit(True)),
         "coalesce(bool_and(coalesce(l_shipdate < TIMESTAMP '2000-01-01', false)), true)",
         hint="[[ACTUAL_VALUE]] late lines",
         spark_actual=lambda: F.count_if(~F.coalesce(col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"), F.lit(False))),
         sql_actual="count_if(NOT coalesce(l_shipdate < TIMESTAMP '2000-01-01', false))"),
    Spec("discount_set", "discount never null", lambda: F.coalesce(F.every(F.coalesce(col("l_discount").isNotNull(), F.lit(False))), F.lit(True)),
         "coalesce(bool_and(coalesce(l_discount IS NOT NULL, false)), true)", depends_on=["tax_nonneg"]),
]
_suite_query("check_bool", "bool", "SELECT * FROM lineitem", lambda t: t.lineitem, _BOOL,
             "Row 90: test_true / test_false as every-row predicates.")

_DOCS_LABELS_SQL = "SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def _docs_labels(t):
    d = t.documents.select("doc_id", "n_chars")
    lab = t.labels.select(col("doc_id").alias("l_doc_id"), "quality")
    return d.join(lab, d.doc_id == lab.l_doc_id, "left")


_NULLS = [
    Spec("doc_id_set", "every document has an id", lambda: F.count_if(col("doc_id").isNull()) == 0,
         "count_if(doc_id IS NULL) = 0"),
    Spec("no_negative_len", "no negative length is set",
         lambda: F.count_if(F.when(col("n_chars") < 0, col("n_chars")).isNotNull()) == 0,
         "count_if((CASE WHEN n_chars < 0 THEN n_chars END) IS NOT NULL) = 0"),
    Spec("all_labelled", "every document has a quality label", lambda: F.count_if(col("quality").isNull()) == 0,
         "count_if(quality IS NULL) = 0", hint="[[ACTUAL_VALUE]] unlabelled",
         spark_actual=lambda: F.count_if(col("quality").isNull()), sql_actual="count_if(quality IS NULL)"),
    Spec("none_labelled", "no document has a quality label", lambda: F.count_if(col("quality").isNotNull()) == 0,
         "count_if(quality IS NOT NULL) = 0", depends_on=["doc_id_set"]),
]
_suite_query("check_nulls", "nulls", _DOCS_LABELS_SQL, _docs_labels, _NULLS,
             "Row 91: test_is_none / test_not_none over documents left join labels.")

_COUNT = [
    Spec("dim_64", "every vector has 64 dimensions",
         lambda: F.coalesce(F.every(F.coalesce(F.size("embedding") == 64, F.lit(False))), F.lit(True)),
         "coalesce(bool_and(coalesce(len(embedding) = 64, false)), true)"),
    Spec("ids_unique", "vector ids are unique", lambda: F.count(F.lit(1)) == F.count_distinct("vec_id"),
         "count(*) = count(DISTINCT vec_id)"),
    Spec("ten_labels", "ten distinct labels", lambda: F.count_distinct("label") == 10,
         "count(DISTINCT label) = 10"),
    Spec("rows_500", "500 vectors", lambda: F.count(F.lit(1)) == 500, "count(*) = 500",
         hint="found [[ACTUAL_VALUE]]", spark_actual=lambda: F.count(F.lit(1)), sql_actual="count(*)"),
]
_suite_query("check_count", "count", "SELECT * FROM embeddings", lambda t: t.embeddings, _COUNT,
             "Row 92: test_length as row counts and per-row sizes.")


def _floats_spark(actual, expected, tol):
    a = actual.try_cast("double")
    e = F.lit(expected).cast("double")
    return F.when(actual.isNull() & e.isNull(), True).otherwise(F.coalesce(F.abs(a - e) <= F.lit(tol), F.lit(False)))


def _floats_sql(actual, expected, tol):
    e = "CAST(NULL AS DOUBLE)" if expected is None else f"CAST({expected} AS DOUBLE)"
    return (f"CASE WHEN ({actual}) IS NULL AND {e} IS NULL THEN true "
            f"ELSE coalesce(abs(TRY_CAST(({actual}) AS DOUBLE) - {e}) <= {tol}, false) END")


_FLOATS = [
    Spec("avg_tax", "average tax near 0.04", lambda: _floats_spark(F.avg("l_tax"), 0.04, 0.01),
         _floats_sql("avg(l_tax)", 0.04, 0.01)),
    Spec("avg_discount_tight", "average discount near 0.06 within 0.005",
         lambda: _floats_spark(F.avg("l_discount"), 0.06, 0.005), _floats_sql("avg(l_discount)", 0.06, 0.005)),
    Spec("null_vs_none", "no value compared with None",
         lambda: _floats_spark(F.max(F.when(col("l_quantity") > 100, col("l_quantity"))), None, 0.01),
         _floats_sql("max(CASE WHEN l_quantity > 100 THEN l_quantity END)", None, 0.01), depends_on=[]),
    Spec("text_value", "a text value never compares", lambda: _floats_spark(F.max("l_returnflag"), 1.0, 0.01),
         _floats_sql("max(l_returnflag)", 1.0, 0.01), depends_on=["avg_tax"]),
]
_suite_query("check_floats", "floats", "SELECT * FROM lineitem", lambda t: t.lineitem, _FLOATS,
             "Row 93: test_floats with tolerance, None = None, uncastable fails.")


def _cust_nation(t):
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select(col("n_nationkey"))
    return c.join(n, c.c_nationkey == n.n_nationkey, "left")


_DOMAIN = [
    Spec("segment_domain", "market segment in the five known",
         lambda: F.count_if(~F.coalesce(col("c_mktsegment").isin(
             ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]), F.lit(False))) == 0,
         "count_if(NOT coalesce(c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'), false)) = 0"),
    Spec("nation_known", "every customer nation exists (domain table)",
         lambda: F.count_if(col("n_nationkey").isNull()) == 0, "count_if(n_nationkey IS NULL) = 0"),
    Spec("segment_short_list", "market segment in a short list",
         lambda: F.count_if(~F.coalesce(col("c_mktsegment").isin(["BUILDING", "HOUSEHOLD"]), F.lit(False))) == 0,
         "count_if(NOT coalesce(c_mktsegment IN ('BUILDING','HOUSEHOLD'), false)) = 0",
         hint="[[ACTUAL_VALUE]] outside",
         spark_actual=lambda: F.count_if(~F.coalesce(col("c_mktsegment").isin(["BUILDING", "HOUSEHOLD"]), F.lit(False))),
         sql_actual="count_if(NOT coalesce(c_mktsegment IN ('BUILDING','HOUSEHOLD'), false))"),
]
_suite_query("check_domain", "domain",
             "SELECT c.*, n.n_nationkey FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey",
             _cust_nation, _DOMAIN, "Row 94: test_contains as literal domain and domain-table join.")


# Named-check registry (rows 86, 87): user Column builders registered by name
# and attached to a suite like built-in kinds.
CHECK_REGISTRY: dict[str, object] = {}


def register_check(name):
    def deco(builder):
        CHECK_REGISTRY[name] = builder
        return builder
    return deco


@register_check("revenue_positive")
def _revenue_positive():
    rev = col("l_extendedprice") * (1 - col("l_discount"))
    return F.coalesce(F.every(F.coalesce(rev > 0, F.lit(False))), F.lit(True))


@register_check("returns_under_half")
def _returns_under_half():
    return F.count_if(col("l_returnflag") == "R") * 2 < F.count(F.lit(1))


_CUSTOM = [
    Spec("revenue_positive", "net revenue positive on every line", lambda: CHECK_REGISTRY["revenue_positive"](),
         "coalesce(bool_and(coalesce(l_extendedprice * (1 - l_discount) > 0, false)), true)"),
    Spec("returns_under_half", "fewer than half the lines are returns", lambda: CHECK_REGISTRY["returns_under_half"](),
         "count_if(l_returnflag = 'R') * 2 < count(*)", points=3),
    # row 100: fail / fail_pre_req -- a constant failure row
    Spec("prerequisites", "Execute prerequisites", lambda: F.lit(False), "false", depends_on=[]),
]
_suite_query("custom_check", "custom", "SELECT * FROM lineitem", lambda t: t.lineitem, _CUSTOM,
             "Rows 86-87: user checks from a named registry of Column builders.")


def _even_cents(price):
    return (price * 100).round() % 2 == 0


def _charge_at_most(price, discount, tax):
    return price * (1 - discount) * (1 + tax) < 100_000


def _refuses_small(quantity):
    if (quantity < 2).any():
        raise ValueError("a quantity below 2")
    return quantity > 0


@query("vectorised_checks", """
WITH a AS (SELECT count(*) AS n, count_if(NOT coalesce(round(l_extendedprice * 100) % 2 = 0, false)) AS f1,
  count_if(NOT coalesce(l_extendedprice * (1 - l_discount) * (1 + l_tax) < 100000, false)) AS f2, count_if(l_quantity < 2) > 0 AS raises FROM lineitem)
SELECT 'even_cents' AS check_id, CAST(n AS BIGINT) AS n, CAST(f1 AS BIGINT) AS failed, NULL AS error, f1 = 0 AS passed FROM a
UNION ALL SELECT 'charge', n, f2, NULL, f2 = 0 FROM a
UNION ALL SELECT 'refuses', n, 0, CASE WHEN raises THEN 'ValueError: a quantity below 2' END, NOT raises FROM a""")
def vectorised_checks(t):
    """Row 86: callers' Python functions of whole column batches as checks,
    one pass for all, counts added up over the partitions; one of them raises."""
    r = V.vector_results(t.lineitem, {"even_cents": (_even_cents, ["l_extendedprice"]),
                                      "charge": (_charge_at_most, ["l_extendedprice", "l_discount", "l_tax"]),
                                      "refuses": (_refuses_small, ["l_quantity"])})
    return r.select("check_id", "n", "failed", "error", "passed")


# ---- a suite over frames, rows, schemas and sequences (rows 95-99, 101) ----

from assay.plans.diffs import ALTERED_ORDERS_SQL, ORDER_COLS, altered_orders  # noqa: E402

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

_FRAME_SPECS = [
    Spec("same_orders", "orders equal their revised copy", None,
         f"""(SELECT count(*) FROM (SELECT {', '.join(ORDER_COLS)}, sum(s) AS d FROM (
              SELECT *, 1 AS s FROM orders UNION ALL SELECT *, -1 AS s FROM ({ALTERED_ORDERS_SQL})) GROUP BY ALL
              HAVING sum(s) <> 0)) = 0""",
         hint="[[ACTUAL_VALUE]] differing rows",
         sql_actual=f"""(SELECT count(*) FROM (SELECT {', '.join(ORDER_COLS)}, sum(s) AS d FROM (
              SELECT *, 1 AS s FROM orders UNION ALL SELECT *, -1 AS s FROM ({ALTERED_ORDERS_SQL})) GROUP BY ALL
              HAVING sum(s) <> 0))"""),
    Spec("customers_keyed", "customer rows equal themselves by key", None, "true", depends_on=[]),
    Spec("orderdate_field", 'Schema contains "o_orderdate" of type TimestampNTZType', None,
         "(SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders' AND column_name = 'o_orderdate' "
         "AND data_type = 'TIMESTAMP') = 1", depends_on=[], hint="Found [[ACTUAL_VALUE]]",
         sql_actual="'o_orderdate, TimestampNTZType, True'"),
    Spec("comment_field", 'Schema contains "o_comment" of type StringType', None,
         "(SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders' AND column_name = 'o_comment') = 1",
         hint="Found [[ACTUAL_VALUE]]", sql_actual="NULL"),
    Spec("priorities", "the five priorities, any order", None,
         f"""(SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)) = 5
             AND (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority AS v FROM orders
                  WHERE o_orderpriority NOT IN ({', '.join(f"'{p}'" for p in PRIORITIES)}))) = 0""", depends_on=[]),
    Spec("positive_prices", "every price is positive", None,
         "coalesce(bool_and(coalesce(o_totalprice > 0, false)), true)"),
    Spec("three_statuses", "three order statuses", None, "count(DISTINCT o_orderstatus) = 3"),
]


@query("frame_suite", suite_sql("SELECT * FROM orders", "orders", _FRAME_SPECS))
def frame_suite(t):
    """Rows 95-99, 101: one suite mixing frame equality (multiset diff),
    keyed row equality, schema fields and an unordered sequence with
    per-row checks; frame-level checks are scalar subqueries, the per-row
    ones share the single aggregate pass over orders."""
    o = t.orders
    s = (C.Suite("orders")
         .test_data_frames(o, altered_orders(t), "orders equal their revised copy", test_case_id="same_orders",
                           hint="[[ACTUAL_VALUE]] differing rows")
         .test_rows(t.customer, t.customer, ["c_custkey"], "customer rows equal themselves by key",
                    test_case_id="customers_keyed", depends_on=[])
         .test_schema_field(o, "o_orderdate", "TimestampNTZType", test_case_id="orderdate_field", depends_on=[])
         .test_schema_field(o, "o_comment", "StringType", test_case_id="comment_field")
         .test_sequence(o.select("o_orderpriority").distinct(), "o_orderpriority", PRIORITIES, False,
                        "the five priorities, any order", test_case_id="priorities", depends_on=[])
         .test_true(F.col("o_totalprice") > 0, "every price is positive", test_case_id="positive_prices")
         .test_equals(F.count_distinct("o_orderstatus"), 3, "three order statuses", test_case_id="three_statuses"))
    return s.run(o)
