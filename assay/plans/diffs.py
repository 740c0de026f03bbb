"""Family D: frame, row, schema, snapshot, tree, spec and policy comparisons
(rows 22, 23, 96-99, 106-108)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from assay.operators import diff as D
from assay.plans.registry import query
from assay.sources.tables import TABLES

col = F.col


def altered_orders(t):
    """orders with the price changed where o_orderkey % 1000 = 0."""
    o = t.orders
    return o.withColumn("o_totalprice", F.when(col("o_orderkey") % 1000 == 0, col("o_totalprice") + 1)
                        .otherwise(col("o_totalprice")))


ALTERED_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 1000 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders"""

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("frame_compare_multiset", f"""
WITH u AS (SELECT *, 1 AS s FROM orders UNION ALL SELECT *, -1 AS s FROM ({ALTERED_ORDERS_SQL})),
g AS (SELECT {', '.join(ORDER_COLS)}, sum(s) AS d FROM u GROUP BY ALL HAVING sum(s) <> 0)
SELECT {', '.join(ORDER_COLS)}, CASE WHEN d > 0 THEN 'left_only' ELSE 'right_only' END AS side,
  CAST(abs(d) AS BIGINT) AS n FROM g""")
def frame_compare_multiset(t):
    """Row 97, multiset mode: signed group-by over all columns."""
    return D.multiset_diff(t.orders, altered_orders(t))


def _changed_cols_sql(cols, a="a", b="b"):
    parts = [f"CASE WHEN {a}.{c} IS DISTINCT FROM {b}.{c} THEN '{c}' END" for c in cols]
    return f"concat_ws(',', {', '.join(parts)})"


_VALS = [c for c in ORDER_COLS if c != "o_orderkey"]


def _lists_sql(cols):
    """Each column, and the whole row, of a key's rows as a sorted list."""
    row = "{" + ", ".join(f"'{c}': {c}" for c in cols) + "}"
    return ", ".join(f"list_sort(list({c})) AS {c}" for c in cols) + f", list_sort(list({row})) AS _row, count(*) AS _n"


def loose_key(key, by):
    """Keys that are null, and keys that repeat."""
    return F.when(col(by) % 500 == 0, F.lit(None)).when(col(by) % 100 == 1, col(key) - 1).otherwise(col(key))


def _loose_key_sql(key):
    return f"CASE WHEN {key} % 500 = 0 THEN NULL WHEN {key} % 100 = 1 THEN {key} - 1 ELSE {key} END"


@query("frame_compare_keyed", f"""
WITH a AS (SELECT k, {_lists_sql(_VALS)} FROM (SELECT *, {_loose_key_sql('o_orderkey')} AS k FROM orders) GROUP BY k),
b AS (SELECT k, {_lists_sql(_VALS)} FROM (SELECT *, {_loose_key_sql('o_orderkey')} AS k FROM ({ALTERED_ORDERS_SQL}) WHERE o_orderkey % 777 <> 3) GROUP BY k),
j AS (SELECT coalesce(a.k, b.k) AS o_orderkey,
        CASE WHEN b._n IS NULL THEN 'left_only' WHEN a._n IS NULL THEN 'right_only'
             WHEN a._row IS DISTINCT FROM b._row THEN 'changed' END AS kind,
        CASE WHEN a._n IS NOT NULL AND b._n IS NOT NULL THEN {_changed_cols_sql(_VALS)} END AS changed_columns
      FROM a FULL OUTER JOIN b ON a.k IS NOT DISTINCT FROM b.k)
SELECT * FROM j WHERE kind IS NOT NULL""")
def frame_compare_keyed(t):
    """Row 97, keyed mode: per key the presence and the changed column names,
    with null and repeated keys."""
    key = loose_key("o_orderkey", "o_orderkey")
    a = t.orders.select(*ORDER_COLS).withColumn("o_orderkey", key)
    b = altered_orders(t).where(col("o_orderkey") % 777 != 3).select(*ORDER_COLS).withColumn("o_orderkey", key)
    return D.keyed_diff(a, b, ["o_orderkey"])


@query("frame_compare_ordered", f"""
WITH a AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders),
b AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM ({ALTERED_ORDERS_SQL})),
j AS (SELECT CAST(coalesce(a.row_idx, b.row_idx) AS BIGINT) AS row_idx,
        CASE WHEN b.row_idx IS NULL THEN 'left_only' WHEN a.row_idx IS NULL THEN 'right_only'
             WHEN {_changed_cols_sql(ORDER_COLS)} <> '' THEN 'changed' END AS kind,
        CASE WHEN a.row_idx IS NOT NULL AND b.row_idx IS NOT NULL THEN {_changed_cols_sql(ORDER_COLS)} END AS changed_columns
      FROM a FULL OUTER JOIN b ON a.row_idx = b.row_idx)
SELECT * FROM j WHERE kind IS NOT NULL""")
def frame_compare_ordered(t):
    """Row 97, ordered mode: positional compare on the caller's order via a
    distributed row index (range partitioning + per-partition offsets)."""
    return D.ordered_diff(t.orders, altered_orders(t), ["o_orderkey"])


@query("frame_compare_verdict", f"""
WITH u AS (SELECT *, 1 AS s FROM orders UNION ALL SELECT *, -1 AS s FROM ({ALTERED_ORDERS_SQL})),
g AS (SELECT {', '.join(ORDER_COLS)}, sum(s) AS d FROM u GROUP BY ALL HAVING sum(s) <> 0)
SELECT CAST(count(*) AS BIGINT) AS n_differences, count(*) = 0 AS equal FROM g""")
def frame_compare_verdict(t):
    """Row 97: the test_data_frames verdict (empty diff = equal)."""
    return D.frame_summary(D.multiset_diff(t.orders, altered_orders(t)))


_CUST = ["c_name", "c_nationkey", "c_mktsegment"]


@query("check_rows", f"""
WITH x AS (SELECT *, {_loose_key_sql('c_custkey')} AS k FROM customer),
a AS (SELECT k, {_lists_sql(_CUST)} FROM x GROUP BY k),
b AS (SELECT k, {_lists_sql(_CUST)} FROM (
        SELECT k, c_name, CASE WHEN c_custkey % 50 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS c_nationkey,
             CASE WHEN c_custkey % 70 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM x WHERE c_custkey % 97 <> 1) GROUP BY k)
SELECT coalesce(a.k, b.k) AS c_custkey,
  a._n IS NOT NULL AND b._n IS NOT NULL AND a._row IS NOT DISTINCT FROM b._row AS rows_equal
FROM a FULL OUTER JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def check_rows(t):
    """Row 96: rows compared as name-keyed dicts per key: column order is
    ignored, None equals None, a missing row is unequal, null keys are equal
    and the rows of a repeated key are compared as a multiset (customer
    against a revised copy)."""
    key = loose_key("c_custkey", "c_custkey").alias("k")
    x = t.customer.select("c_custkey", *_CUST, key)
    a = x.select("k", *_CUST)
    b = (x.where(col("c_custkey") % 97 != 1)
         .withColumn("c_nationkey", F.when(col("c_custkey") % 50 == 0, (col("c_nationkey") + 1) % 25)
                     .otherwise(col("c_nationkey")))
         .withColumn("c_mktsegment", F.when(col("c_custkey") % 70 == 0, F.lit(None)).otherwise(col("c_mktsegment")))
         .select("c_mktsegment", "c_nationkey", "c_name", "k"))   # column order is ignored
    return D.rows_equal(a, b, ["k"]).withColumnRenamed("k", "c_custkey")


# Expected fields for the schema audit: (table, field, class name, nullable or None).
SCHEMA_EXPECTATIONS = [
    ("lineitem", "l_orderkey", "LongType", None),
    ("lineitem", "l_quantity", "DecimalType", None),
    ("orders", "o_orderdate", "TimestampNTZType", None),
    ("orders", "o_comment", "StringType", None),
    ("embeddings", "embedding", "ArrayType", None),
    ("customer", "c_acctbal", "DoubleType", True),
    ("part", "p_size", "IntegerType", None),
    ("events", "ts", "TimestampType", None),
    ("documents", "text", "StringType", True),
    ("labels", "quality", "IntegerType", None),
]

_DUCK_TO_SPARK = {"BIGINT": "LongType", "INTEGER": "IntegerType", "VARCHAR": "StringType",
                  "DOUBLE": "DoubleType", "TIMESTAMP": "TimestampNTZType", "FLOAT[]": "ArrayType",
                  "BOOLEAN": "BooleanType", "FLOAT": "FloatType"}


def _schema_audit_sql():
    exp = ", ".join(f"('{a}', '{b}', '{c}', {('NULL' if d is None else str(d).lower())})"
                    for a, b, c, d in SCHEMA_EXPECTATIONS)
    mapping = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DUCK_TO_SPARK.items())
    return f"""
WITH s AS (SELECT table_name AS tbl, column_name AS name, CASE data_type {mapping} ELSE data_type END AS type,
             is_nullable = 'YES' AS nullable FROM information_schema.columns),
e AS (SELECT * FROM (VALUES {exp}) v(tbl, name, expected_type, expected_nullable))
SELECT e.tbl AS table_name, e.name AS field, e.expected_type, nc.null_count,
  s.name IS NOT NULL AND s.type = e.expected_type AND (e.expected_nullable IS NULL OR s.nullable = e.expected_nullable) AS passed,
  CASE WHEN s.name IS NULL THEN NULL WHEN e.expected_nullable IS NULL THEN s.name || ', ' || s.type || ', ' || CASE WHEN s.nullable THEN 'True' ELSE 'False' END
       ELSE s.name || ', ' || s.type END AS found
FROM e LEFT JOIN s ON s.tbl = e.tbl AND s.name = e.name
LEFT JOIN (""" + " UNION ALL ".join(
        f"SELECT '{a}' AS tbl, '{b}' AS name, CAST(count_if({b} IS NULL) AS BIGINT) AS null_count FROM {a}"
        for a, b, _, _ in SCHEMA_EXPECTATIONS if b != "o_comment") + """) nc ON nc.tbl = e.tbl AND nc.name = e.name"""


@query("schema_audit", _schema_audit_sql())
def schema_audit(t):
    """Row 98: test_schema_field for a list of expected fields over every
    table's schema-as-a-table (schemas come from the parquet footers), with
    the nulls each audited field holds in the data (one pass per table)."""
    spark = t.spark
    schemas = reduce(lambda a, b: a.unionByName(b),
                     [D.schema_table(spark, getattr(t, name), name) for name in TABLES])
    exp = spark.createDataFrame(SCHEMA_EXPECTATIONS, "table string, name string, expected_type string, "
                                                     "expected_nullable boolean")
    j = exp.join(schemas.select("table", "name", "type", "nullable"), ["table", "name"], "left")
    # the data side of the audit: nulls per audited field, one pass per table
    present = {(name, f.name) for name in TABLES for f in getattr(t, name).schema.fields}   # metadata only
    counts = None
    for name in sorted({tb for tb, _, _, _ in SCHEMA_EXPECTATIONS}):
        fields = [f for tb, f, _, _ in SCHEMA_EXPECTATIONS if tb == name and (tb, f) in present]
        if not fields:
            continue
        one = getattr(t, name).agg(*[F.count_if(col(f).isNull()).alias(f) for f in fields])
        rows = one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("table"), F.lit(f).alias("name"),
                                                      col(f).alias("null_count")) for f in fields])))
        counts = rows if counts is None else counts.unionByName(rows)
    j = j.join(counts, ["table", "name"], "left")
    passed = (col("type").isNotNull() & (col("type") == col("expected_type"))
              & (col("expected_nullable").isNull() | (col("nullable") == col("expected_nullable"))))
    found = (F.when(col("type").isNull(), F.lit(None))
             .when(col("expected_nullable").isNull(),
                   F.concat_ws(", ", "name", "type", F.when(col("nullable"), "True").otherwise("False")))
             .otherwise(F.concat_ws(", ", "name", "type")))
    return j.select(col("table").alias("table_name"), col("name").alias("field"), "expected_type", "null_count",
                    F.coalesce(passed, F.lit(False)).alias("passed"), found.alias("found"))


_B_SELECT = ("SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderdate, "
             "o_orderpriority, 'x' AS o_comment FROM orders")
_B_COLS = ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_comment"]


@query("schema_compare", f"""
WITH a AS (SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type_a, CAST(row_number() OVER () AS INTEGER) AS pos_a
           FROM (DESCRIBE orders)),
b AS (SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type_b, CAST(row_number() OVER () AS INTEGER) AS pos_b
      FROM (DESCRIBE {_B_SELECT})),
ra AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS rows_a FROM orders" for c in ORDER_COLS)}),
rb AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS rows_b FROM ({_B_SELECT})" for c in _B_COLS)}),
j AS (SELECT coalesce(a.name, b.name) AS name, type_a, type_b, pos_a, pos_b FROM a FULL OUTER JOIN b ON a.name = b.name)
SELECT j.name, type_a, type_b, pos_a, pos_b,
  CASE WHEN type_b IS NULL THEN 'only_a' WHEN type_a IS NULL THEN 'only_b' WHEN type_a <> type_b THEN 'type'
       WHEN pos_a IS DISTINCT FROM pos_b THEN 'position' ELSE 'same' END AS kind,
  type_a IS NOT DISTINCT FROM type_b AND pos_a IS NOT DISTINCT FROM pos_b AS matches, rows_a, rows_b
FROM j LEFT JOIN ra ON j.name = ra.name LEFT JOIN rb ON j.name = rb.name""")
def schema_compare(t):
    """Row 99: compare_schemas of orders and a reshaped copy (column moved,
    type changed, column dropped, column added); nullability ignored; with
    the non-null values per column on each side."""
    spark = t.spark
    a = t.orders
    b = (t.orders.select("o_custkey", "o_orderkey", col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                         "o_orderdate", "o_orderpriority", F.lit("x").alias("o_comment")))
    cmp = D.schema_compare(D.schema_table(spark, a, "a"), D.schema_table(spark, b, "b"), test_column_order=True)
    return cmp.join(_non_null_counts(a, "rows_a"), "name", "left").join(_non_null_counts(b, "rows_b"), "name", "left")


# column -> type asked for, the same in the oracle's SQL, and the column's own type there
_CASTS = {"p_partkey": ("tinyint", "TINYINT", "BIGINT"), "p_name": ("bigint", "BIGINT", "VARCHAR"), "p_size": ("string", "VARCHAR", "BIGINT"),
          "p_retailprice": ("int", "INTEGER", "DOUBLE"), "p_brand": ("string", "VARCHAR", "VARCHAR")}


def _cast_sql(name: str, type_b: str, duck: str, own: str) -> str:
    y = f"TRY_CAST({name} AS {duck})"
    return f"""SELECT '{name}' AS name, '{type_b}' AS type_b, CAST(count({name}) AS BIGINT) AS n,
  CAST(count_if({name} IS NOT NULL AND {y} IS NULL) AS BIGINT) AS n_bad,
  CAST(count_if({y} IS NOT NULL AND TRY_CAST({y} AS {own}) IS DISTINCT FROM {name}) AS BIGINT) AS n_lossy,
  count_if({name} IS NOT NULL AND {y} IS NULL) = 0 AS fits FROM part"""


@query("schema_castable", " UNION ALL ".join(_cast_sql(c, *x) for c, x in _CASTS.items()))
def schema_castable(t):
    """Row 99 from the data: whether the rows of part fit the types of
    another schema, and whether they come back unchanged."""
    return D.castable(t.part, {c: x[0] for c, x in _CASTS.items()}).drop("type_a")


def _non_null_counts(df, out: str):
    """Non-null values per column, one aggregate pass, unpivoted to (name, out)."""
    one = df.agg(*[F.count(col(c)).alias(c) for c in df.columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), col(c).alias(out)) for c in df.columns])))


def doc_tree(t, target: bool):
    d = t.documents.select("doc_id", "source", "lang")
    if target:
        d = (d.where(col("doc_id") % 3 != 0)
             .withColumn("lang", F.when(col("doc_id") % 4 == 0, F.lit("en")).otherwise(col("lang"))))
    files = d.select(F.concat(F.lit("/"), col("source"), F.lit("/"), col("doc_id").cast("string")).alias("path"),
                     F.lit("NOTEBOOK").alias("object_type"), col("lang").alias("language"))
    dirs = d.select(F.concat(F.lit("/"), col("source")).alias("path")).distinct().select(
        "path", F.lit("DIRECTORY").alias("object_type"), F.lit(None).cast("string").alias("language"))
    return files.unionByName(dirs)


def _doc_tree_sql(target: bool):
    where = "WHERE doc_id % 3 <> 0" if target else ""
    lang = "CASE WHEN doc_id % 4 = 0 THEN 'en' ELSE lang END" if target else "lang"
    return f"""SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) AS path, 'NOTEBOOK' AS object_type, {lang} AS language
      FROM documents {where}
      UNION ALL SELECT DISTINCT '/' || source AS path, 'DIRECTORY' AS object_type, NULL AS language FROM documents {where}"""


@query("tree_compare", f"""
WITH s AS ({_doc_tree_sql(False)}), t AS ({_doc_tree_sql(True)}),
j AS (SELECT coalesce(s.path, t.path) AS path,
        CASE WHEN t.path IS NULL THEN 'source_only' WHEN s.path IS NULL THEN 'target_only'
             WHEN s.object_type IS DISTINCT FROM t.object_type OR s.language IS DISTINCT FROM t.language THEN 'mismatch' END AS kind,
        s.object_type AS s_object_type, s.language AS s_language, t.object_type AS t_object_type, t.language AS t_language
      FROM s FULL OUTER JOIN t ON s.path = t.path)
SELECT * FROM j WHERE kind IS NOT NULL""")
def tree_compare(t):
    """Row 22: listings compared by relative path, type and language."""
    return D.tree_compare(doc_tree(t, False), doc_tree(t, True))


def snapshot_sides(t):
    d = t.documents.select("doc_id", "source", "text")
    path = F.concat(F.lit("/"), col("source"), F.lit("/"), col("doc_id").cast("string"))
    a = d.select(path.alias("path"), col("text").alias("contents"))
    b = (d.where(col("doc_id") % 13 != 0)
         .select(path.alias("path"),
                 F.when(col("doc_id") % 11 == 0, F.concat(col("text"), F.lit("\nedited"))).otherwise(col("text"))
                 .alias("contents")))
    added = d.where(col("doc_id") % 17 == 0).select(F.concat(path, F.lit(".new")).alias("path"),
                                                    col("text").alias("contents"))
    return a, b.unionByName(added)


def _thousands_sql(x):
    return "format('{:,}', " + x + ")"


@query("snapshot_diff", f"""
WITH a AS (SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) AS path, text AS contents FROM documents),
b AS (SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) AS path,
        CASE WHEN doc_id % 11 = 0 THEN text || chr(10) || 'edited' ELSE text END AS contents
      FROM documents WHERE doc_id % 13 <> 0
      UNION ALL SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.new', text FROM documents WHERE doc_id % 17 = 0),
j AS (SELECT coalesce(a.path, b.path) AS path,
        CASE WHEN b.path IS NULL THEN 'deleted' WHEN a.path IS NULL THEN 'added'
             WHEN a.contents <> b.contents THEN 'differs' END AS kind,
        CAST(length(a.contents) AS INTEGER) AS len_a, CAST(length(b.contents) AS INTEGER) AS len_b
      FROM a FULL OUTER JOIN b ON a.path = b.path),
l AS (SELECT *, {_thousands_sql('len_a')} || ' vs ' || {_thousands_sql('len_b')} || ':' AS label FROM j)
SELECT path, kind, len_a, len_b,
  CASE kind WHEN 'deleted' THEN 'Notebook deleted: `' || path || '`'
            WHEN 'added' THEN 'Notebook added: `' || path || '`'
            ELSE 'Differences: ' || CASE WHEN length(label) < 20 THEN lpad(label, 20, ' ') ELSE label END || ' ' || path END AS message
FROM l WHERE kind IS NOT NULL""")
def snapshot_diff(t):
    """Row 23: deleted / added / differs between two snapshots of documents."""
    a, b = snapshot_sides(t)
    return D.snapshot_diff(a, b)


# Spec for the drift audit (a literal, small by construction) and the
# name prefixes excluded from it.
PART_SPEC = {"p_brand": "Brand#2", "p_type": "ECONOMY", "p_size": 11}
EXCLUDED_PREFIXES = ["red ", "hot "]


@query("spec_drift", """
WITH p AS (SELECT * FROM part WHERE substr(p_name, 1, 4) NOT IN ('red ', 'hot ') AND p_type <> 'PROMO'),
e AS (SELECT p_partkey, p_name, concat_ws(', ',
        CASE WHEN p_brand IS DISTINCT FROM 'Brand#2' THEN 'p_brand=' || coalesce(p_brand, 'None') END,
        CASE WHEN p_type IS DISTINCT FROM 'ECONOMY' THEN 'p_type=' || coalesce(p_type, 'None') END,
        CASE WHEN p_size IS DISTINCT FROM 11 THEN 'p_size=' || coalesce(CAST(p_size AS VARCHAR), 'None') END) AS error
      FROM p)
SELECT * FROM e WHERE error <> ''""")
def spec_drift(t):
    """Row 106: each record against the spec; differing fields as 'k=v, ...'.
    Records from excluded sources (PROMO) and name prefixes are skipped."""
    p = t.part.where(~F.substring("p_name", 1, 4).isin(EXCLUDED_PREFIXES) & (col("p_type") != "PROMO"))
    return D.spec_drift(p, PART_SPEC, ["p_partkey", "p_name"])


def policies(t):
    """events as policy definitions (JSON) with a users-group ACL entry."""
    e = t.events.select("event_id", "user_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    definition = F.to_json(F.struct(
        F.struct(F.when(col("event_type") == "view", "dlt").otherwise("all-purpose").alias("value")).alias("cluster_type"),
        F.struct(F.concat(F.lit("pool-"), (k % 5).cast("string")).alias("value")).alias("instance_pool_id")))
    name = F.concat(F.when(col("user_id") % 2 == 0, "Student-").otherwise("Admin-"), col("event_id").cast("string"))
    perm = F.when(k % 3 != 0, "CAN_USE").otherwise("CAN_VIEW")
    entry = lambda group, level: F.struct(group.alias("group_name"), F.array(
        F.struct(level.alias("permission_level"))).alias("all_permissions"))
    # a user's entry, which has no group, beside that of the group; some policies without entries
    acl = F.when(k % 17 != 0, F.array(entry(F.lit(None).cast("string"), F.lit("CAN_MANAGE")), entry(F.lit("users"), perm)))
    return e.select(name.alias("name"), definition.alias("definition"), acl.alias("access_control_list"))


@query("policy_audit", """
WITH e AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
p AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'Student-' ELSE 'Admin-' END || CAST(event_id AS VARCHAR) AS name,
        CASE WHEN event_type = 'view' THEN 'dlt' ELSE 'all-purpose' END AS cluster_type,
        'pool-' || CAST(k % 5 AS VARCHAR) AS pool, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 3 <> 0 THEN 'CAN_USE' ELSE 'CAN_VIEW' END AS perm
      FROM e)
SELECT name AS policy, 'Wrong instance pool' AS error FROM p WHERE cluster_type <> 'dlt' AND pool <> 'pool-0'
UNION ALL
SELECT name, 'Missing users access' FROM p WHERE starts_with(name, 'Student') AND perm IS DISTINCT FROM 'CAN_USE'""")
def policy_audit(t):
    """Row 107: policy JSON whose pool differs from the expected one (unless
    a pipeline policy), and student policies lacking CAN_USE for 'users'."""
    return D.policy_audit(policies(t), "name", "definition", "access_control_list", "pool-0")


@query("artifact_presence", r"""
WITH m AS (SELECT DISTINCT sha256(text) AS h FROM documents)
SELECT b.item_id, m.h IS NOT NULL AS present,
  CAST((SELECT count(*) FROM documents
        WHERE list_contains(regexp_extract_all(text, '\*\*([0-9]+)\*\*', 1), CAST(b.item_id AS VARCHAR))) AS BIGINT) AS marker_docs
FROM benchmark b LEFT JOIN m ON sha256(b.text) = m.h""")
def artifact_presence(t):
    """Row 108: expected artefacts (benchmark items) left-joined to the
    published set by content digest, plus version-marker hits per item."""
    docs = t.documents.select(F.sha2("text", 256).alias("h"), "text")
    present = docs.select("h").distinct().withColumn("_p", F.lit(True))
    b = t.benchmark.select("item_id", F.sha2("text", 256).alias("h"))
    # markers "**<id>**" are found by extracting every **digits** token once
    # per document and joining on the id: one pass, no pairwise contains
    markers = (docs.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\*\*([0-9]+)\*\*"), 1)))
                           .alias("m"))
               .groupBy("m").agg(F.count(F.lit(1)).alias("marker_docs")))
    j = b.join(present, "h", "left").join(markers, b.item_id.cast("string") == markers.m, "left")
    return j.select("item_id", F.coalesce(col("_p"), F.lit(False)).alias("present"),
                    F.coalesce(col("marker_docs"), F.lit(0).cast("bigint")).alias("marker_docs"))
