"""Sources and sinks (rows 5-9, 11), list comparison (61) and the
per-record user function with errors as data (88)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from assay.operators.apply import rows_of_keys, rows_of_records, try_with_errors
from assay.plans import standins as S
from assay.plans.registry import query
from assay.sources import files as FS
from assay.sources import sinks
from assay.sources.files import read_csv_strict

col = F.col


def part_configs(t):
    """one JSON config text per part: valid, wrongly typed, or malformed."""
    p = t.part
    pk = col("p_partkey")
    v = F.concat_ws(".", col("p_size").cast("string"), (pk % 100).cast("string"), (pk % 7).cast("string"))
    head = F.concat(F.lit('{"name": "'), col("p_name"), F.lit('"'))
    js = (F.when(pk % 13 == 0, F.concat(head, F.lit(', "rounds": ')))
          .when(pk % 11 == 0, F.concat(head, F.lit(', "version": "'), v, F.lit('", "rounds": "x'),
                                       col("p_size").cast("string"), F.lit('"}')))
          .otherwise(F.concat(head, F.lit(', "version": "'), v, F.lit('", "rounds": '), col("p_size").cast("string"),
                              F.lit("}"))))
    return p.select("p_partkey", "p_brand", js.alias("config"))


CONFIG_SCHEMA = "name string, version string, rounds int"


@query("config_overrides", """
WITH c AS (SELECT p_partkey, p_brand,
  CASE WHEN p_partkey % 13 = 0 THEN '{"name": "' || p_name || '", "rounds": '
       WHEN p_partkey % 11 = 0 THEN '{"name": "' || p_name || '", "version": "' || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 100 AS VARCHAR) || '.' || CAST(p_partkey % 7 AS VARCHAR) || '", "rounds": "x' || CAST(p_size AS VARCHAR) || '"}'
       ELSE '{"name": "' || p_name || '", "version": "' || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 100 AS VARCHAR) || '.' || CAST(p_partkey % 7 AS VARCHAR) || '", "rounds": ' || CAST(p_size AS VARCHAR) || '}' END AS config
  FROM part),
p AS (SELECT p_partkey, p_brand, json_valid(config) AS ok,
        CASE WHEN json_valid(config) THEN json_extract_string(config, '$.name') END AS name,
        CASE WHEN json_valid(config) THEN json_extract_string(config, '$.version') END AS version,
        CASE WHEN json_valid(config) THEN TRY_CAST(json_extract(config, '$.rounds') AS INTEGER) END AS rounds,
        coalesce(CASE WHEN json_valid(config) THEN list_contains(json_keys(config), 'rounds')
          AND TRY_CAST(json_extract(config, '$.rounds') AS INTEGER) IS NULL END, false) AS type_error
      FROM c),
o AS (SELECT 'Brand#' || CAST(n_nationkey AS VARCHAR) AS p_brand, n_regionkey + 1 AS rounds FROM nation WHERE n_nationkey % 3 = 0)
SELECT p.p_partkey, p.name, p.version, coalesce(o.rounds, p.rounds) AS rounds, p.type_error, NOT p.ok AS corrupt,
  o.rounds IS NOT NULL AS overridden
FROM p LEFT JOIN o ON p.p_brand = o.p_brand""")
def config_overrides(t):
    """Row 5: JSON configs parsed with a fixed schema (PERMISSIVE: malformed
    text and wrongly typed fields become flags, not failures), then
    per-brand overrides (from nation) by left join + coalesce."""
    c = FS.parse_json_column(part_configs(t), "config", CONFIG_SCHEMA, ["rounds"])
    o = t.nation.where(col("n_nationkey") % 3 == 0).select(
        F.concat(F.lit("Brand#"), col("n_nationkey").cast("string")).alias("p_brand"),
        (col("n_regionkey") + 1).alias("o_rounds"))
    j = c.join(o, "p_brand", "left")
    return j.select("p_partkey", col("cfg.name").alias("name"), col("cfg.version").alias("version"),
                    F.coalesce("o_rounds", col("cfg.rounds")).alias("rounds"), "type_error", "corrupt",
                    col("o_rounds").isNotNull().alias("overridden"))


PUBLISHING_SCHEMA = ("announcements struct<email_addresses: array<string>, slack_channels: array<struct<name: string, "
                     "url: string>>>, translations map<string, struct<release_repo: string, published_docs_folder: "
                     "string, document_links: array<string>>>")


@query("publishing_links", """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, 'english' AS language, 'https://docs.example.com/en/' || CAST(event_id AS VARCHAR) AS link FROM e
UNION ALL SELECT event_id, 'french', 'https://docs.example.com/fr/' || CAST(event_id AS VARCHAR) || '/a' FROM e
UNION ALL SELECT event_id, 'french', 'https://docs.example.com/fr/' || CAST(event_id AS VARCHAR) || '/b' FROM e WHERE k % 2 = 0""")
def publishing_links(t):
    """Row 6: nested publishing info (a translations map of structs holding
    link arrays) written as JSON and read back with a fixed schema, then
    exploded: map entries, then links."""
    e = t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    base = F.lit("https://docs.example.com/")
    en = F.struct(F.lit("repo-en").alias("release_repo"), F.lit("/docs/en").alias("published_docs_folder"),
                  F.array(F.concat(base, F.lit("en/"), col("event_id").cast("string"))).alias("document_links"))
    fr_links = F.when(col("k") % 2 == 0, F.array(F.concat(base, F.lit("fr/"), col("event_id").cast("string"), F.lit("/a")),
                                                 F.concat(base, F.lit("fr/"), col("event_id").cast("string"), F.lit("/b")))
                      ).otherwise(F.array(F.concat(base, F.lit("fr/"), col("event_id").cast("string"), F.lit("/a"))))
    fr = F.struct(F.lit("repo-fr").alias("release_repo"), F.lit("/docs/fr").alias("published_docs_folder"),
                  fr_links.alias("document_links"))
    info = F.struct(F.struct(F.array(F.lit("team@example.com")).alias("email_addresses"),
                             F.array(F.struct(F.lit("release").alias("name"), F.lit("https://chat.example.com/r").alias("url")))
                             .alias("slack_channels")).alias("announcements"),
                    F.create_map(F.lit("english"), en, F.lit("french"), fr).alias("translations"))
    js = e.select("event_id", F.to_json(info).alias("json"))
    parsed = js.select("event_id", F.from_json("json", PUBLISHING_SCHEMA).alias("p"))
    # (outer: a plain explode puts a filter on the parsed value before the scan, which parses twice)
    langs = parsed.select("event_id", F.explode_outer("p.translations").alias("language", "tr"))
    links = langs.select("event_id", "language", F.explode_outer("tr.document_links").alias("link"))
    return links.where("link is not null")


def _csv_lines(t):
    """part as CSV lines: cells with blanks around them, names in quotes with a
    comma and a quote inside, and some rows with a cell too many."""
    p = t.part
    pk = col("p_partkey")
    name = F.concat(F.lit('"'), col("p_name"), F.lit(', ""'), col("p_type"), F.lit('"""'))
    line = F.concat_ws(",", F.concat(F.lit("  "), pk.cast("string")), name, F.concat(col("p_brand"), F.lit(" ")), col("p_size").cast("string"))
    return p.select(F.when(pk % 17 == 0, F.concat(line, F.lit(",extra"))).otherwise(line).alias("value"))


CSV_SCHEMA = StructType([StructField("Id", LongType()), StructField("name", StringType()), StructField("brand", StringType()),
                         StructField("size", IntegerType())])


@query("csv_strict_load", """
SELECT p_partkey, p_name || ', "' || p_type || '"' AS name, p_brand AS brand, p_size AS size, p_partkey % 17 <> 0 AS width_ok FROM part""")
def csv_strict_load(t):
    """Row 7: CSV text in shared storage read by the CSV source: every cell
    trimmed, quoted cells whole, rows of a different width flagged, 'Id'
    renamed to the key."""
    path = sinks.new_scratch(t.spark, "csv")
    _csv_lines(t).write.mode("overwrite").text(path)
    rec = read_csv_strict(t.spark, path, CSV_SCHEMA)
    return rec.select(col("Id").alias("p_partkey"), "name", "brand", "size", col("_corrupt_record").isNull().alias("width_ok"))


@query("usage_month_range", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1996-01' AND '1996-06' GROUP BY 1""")
def usage_month_range(t):
    """Row 8: a usage report stored partitioned by month; a month range read
    prunes partitions (only the matching folders are listed and scanned)."""
    spark = t.spark
    path = sinks.new_scratch(spark, "usage")
    # A month's rows meet in a few tasks, whose number follows the data, so that files stay few and large.
    (t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).hint("rebalance", "month")
     .write.mode("overwrite").partitionBy("month").parquet(path))
    u = spark.read.parquet(path).where(col("month").between("1996-01", "1996-06"))
    # exact decimal sum (independent of summation order), reported as double
    return u.groupBy("month").agg(F.count(F.lit(1)).alias("n_orders"),
                                  F.sum(col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("run_log_append", f"""
WITH r AS ({S.RUN_RECORDS_SQL})
SELECT suite_id, result_state, CAST(count(*) AS BIGINT) AS n_runs, CAST(sum(execution_duration) AS BIGINT) AS total_ms
FROM r GROUP BY suite_id, result_state""")
def run_log_append(t):
    """Row 9: run records appended in two batches to a log partitioned by
    run date and clustered by suite, then read back as one table."""
    spark = t.spark
    path = sinks.new_scratch(spark, "runlog")
    r = S.run_records(t).select("suite_id", "test_id", "result_state", "execution_duration", "event_id",
                                F.to_date("ts").alias("run_date"))
    sinks.append_run_log(r.where(col("event_id") % 2 == 0), path)
    sinks.append_run_log(r.where(col("event_id") % 2 == 1), path)
    log = spark.read.parquet(path)
    return log.groupBy("suite_id", "result_state").agg(F.count(F.lit(1)).alias("n_runs"),
                                                       F.sum("execution_duration").cast("bigint").alias("total_ms"))


@query("dataset_install", """
SELECT CAST(r AS INTEGER) AS round, d AS dataset, a AS action,
  CASE d WHEN 'supplier' THEN (SELECT count(*) FROM supplier) ELSE (SELECT count(*) FROM customer) END AS rows,
  true AS valid
FROM (VALUES (1, 'supplier', 'installed'), (1, 'customer', 'installed'), (2, 'supplier', 'skipped'),
             (2, 'customer', 'skipped'), (3, 'supplier', 'reinstalled')) v(r, d, a)""")
def dataset_install(t):
    """Row 11: supplier and customer installed as datasets: installed on the
    first round, skipped when present, reinstalled when forced; each round
    validated by counting what is on disk against the source."""
    spark = t.spark
    root = sinks.new_scratch(spark, "datasets")
    plan = [(1, "supplier", False), (1, "customer", False), (2, "supplier", False), (2, "customer", False),
            (3, "supplier", True)]
    rows, source = [], {name: getattr(t, name).count() for name in ("supplier", "customer")}
    for rnd, name, force in plan:
        action = sinks.install_dataset(spark, getattr(t, name), root, name, reinstall=force)
        # validation right after each round (a later reinstall replaces the files)
        n = spark.read.parquet(f"{root}/{name}").count()
        rows.append((rnd, name, action, n, n == source[name]))
    sinks.remove(spark, root)
    return spark.createDataFrame(rows, "round int, dataset string, action string, rows bigint, valid boolean")


@query("list_compare", """
WITH a AS (SELECT o_orderstatus AS st, o_orderpriority AS pr FROM orders),
b AS (SELECT o_orderstatus AS st, CASE WHEN o_orderkey % 1000 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS pr FROM orders
      WHERE o_orderkey % 997 <> 0),
la AS (SELECT st, count(*) AS n FROM a GROUP BY st), lb AS (SELECT st, count(*) AS n FROM b GROUP BY st),
da AS (SELECT DISTINCT st, pr FROM a), db AS (SELECT DISTINCT st, pr FROM b),
miss AS (SELECT st, count(*) AS m FROM (SELECT * FROM da EXCEPT SELECT * FROM db UNION ALL (SELECT * FROM db EXCEPT SELECT * FROM da)) GROUP BY st),
ca AS (SELECT st, pr, count(*) AS n FROM a GROUP BY st, pr), cb AS (SELECT st, pr, count(*) AS n FROM b GROUP BY st, pr),
ms AS (SELECT coalesce(ca.st, cb.st) AS st, count(*) AS d FROM ca FULL OUTER JOIN cb ON ca.st = cb.st AND ca.pr = cb.pr
       WHERE ca.n IS DISTINCT FROM cb.n GROUP BY 1)
SELECT la.st AS status, la.n = lb.n AS length_equal, coalesce(miss.m, 0) = 0 AS members_equal,
  la.n = lb.n AND coalesce(miss.m, 0) = 0 AS unordered_equal, coalesce(ms.d, 0) = 0 AS multiset_equal
FROM la JOIN lb ON la.st = lb.st LEFT JOIN miss ON la.st = miss.st LEFT JOIN ms ON la.st = ms.st""")
def list_compare(t):
    """Row 61: per status, the priority lists of orders and of a revised copy
    compared as the reference does (equal length + membership both ways,
    not a multiset) and strictly (multiset)."""
    o = t.orders
    a = o.select(col("o_orderstatus").alias("st"), col("o_orderpriority").alias("pr"))
    b = o.where(col("o_orderkey") % 997 != 0).select(
        col("o_orderstatus").alias("st"),
        F.when(col("o_orderkey") % 1000 == 0, F.lit("1-URGENT")).otherwise(col("o_orderpriority")).alias("pr"))
    return compare_lists(a, b, "st", "pr").withColumnRenamed("st", "status")


def compare_lists(a, b, key: str, value: str):
    la = a.groupBy(key).agg(F.count(F.lit(1)).alias("na"))
    lb = b.groupBy(key).agg(F.count(F.lit(1)).alias("nb"))
    ca = a.groupBy(key, value).agg(F.count(F.lit(1)).alias("ca"))
    cb = b.groupBy(key, value).agg(F.count(F.lit(1)).alias("cb"))
    j = ca.join(cb, [key, value], "full_outer")
    per = j.groupBy(key).agg(F.count_if(col("ca").isNull() | col("cb").isNull()).alias("missing"),
                             F.count_if(~col("ca").eqNullSafe(col("cb"))).alias("mdiff"))
    r = la.join(lb, key).join(per, key, "left")
    return r.select(key, (col("na") == col("nb")).alias("length_equal"),
                    (F.coalesce("missing", F.lit(0)) == 0).alias("members_equal"),
                    ((col("na") == col("nb")) & (F.coalesce("missing", F.lit(0)) == 0)).alias("unordered_equal"),
                    (F.coalesce("mdiff", F.lit(0)) == 0).alias("multiset_equal"))


@query("map_with_errors", """
SELECT doc_id, CASE WHEN contains(text, 'token = "') THEN NULL ELSE CAST(len(string_split(text, chr(10))) AS INTEGER) END AS n_lines,
  CASE WHEN contains(text, 'token = "') THEN 'ValueError: secret found' END AS error
FROM documents""")
def map_with_errors(t):
    """Rows 88, 132: a function applied to every record, an exception being
    an error value in its row instead of failing the job.  This one (count
    lines, refuse texts with a secret) has built-in functions and stays out of
    Python; a caller's Python function goes through ``apply_with_errors``."""
    refused = F.when(F.contains("text", F.lit('token = "')), F.lit("ValueError: secret found"))
    return try_with_errors(t.documents, F.size(F.split("text", "\n", -1)), refused, ["doc_id"], result="n_lines")


LONG_TURN = 3       # times the turn before


@query("scan_conversations", f"""
WITH c AS (SELECT conv_id, turn, role, text, length(coalesce(text, '')) AS n FROM conversations),
p AS (SELECT *, lag(role) OVER w AS before, lag(n) OVER w AS n_before FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
f AS (
  SELECT conv_id, turn, 1 AS k, 'repeated_role' AS kind, role AS detail, NULL AS error FROM p WHERE role = before
  UNION ALL SELECT conv_id, turn, 2, 'long_turn', CAST(n AS VARCHAR), NULL FROM p WHERE n > {LONG_TURN} * n_before
  UNION ALL SELECT conv_id, NULL, 3, NULL, NULL, 'ValueError: a question is missing in turn ' || turn FROM p
    WHERE role = 'user' AND NOT contains(coalesce(text, ''), '?') AND turn % 5 = 0)
SELECT f.conv_id, CAST(row_number() OVER (PARTITION BY f.conv_id ORDER BY coalesce(f.turn, CAST(regexp_extract(error, '[0-9]+$') AS BIGINT)), k) - 1 AS BIGINT) AS seq,
  f.turn, kind, detail, error FROM f""")
def scan_conversations(t):
    """Rows 88, 132: a caller's function over the rows of each key in order,
    any number of rows out, remembering what came before; a turn that it
    refuses is an error row and the conversation goes on."""
    def make():
        before: list = [None, None]

        def findings(turn, role, text):
            n, (last, length) = len(text or ""), before
            before[:] = role, n
            if role == last:
                yield turn, "repeated_role", role
            if length is not None and n > LONG_TURN * length:
                yield turn, "long_turn", str(n)
            if role == "user" and "?" not in (text or "") and turn % 5 == 0:
                raise ValueError(f"a question is missing in turn {turn}")

        return findings

    return rows_of_keys(t.conversations, make, ["conv_id"], ["turn"], ["turn", "role", "text"], "turn bigint, kind string, detail string")


@query("scan_documents", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS "at" FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, min("at") AS stop FROM l WHERE contains(line, 'token = "') GROUP BY doc_id),
y AS (SELECT l.doc_id, l."at" AS line_no, line FROM l LEFT JOIN s USING (doc_id) WHERE (stop IS NULL OR l."at" < stop) AND length(line) > 400)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS BIGINT) AS seq, CAST(line_no AS BIGINT) AS line_no,
  CAST(length(line) AS BIGINT) AS n_chars, NULL AS error FROM y
UNION ALL SELECT doc_id, (SELECT count(*) FROM y WHERE y.doc_id = s.doc_id), NULL, NULL, 'ValueError: secret in line ' || stop FROM s""")
def scan_documents(t):
    """Rows 88, 132: a caller's function over each record that yields its
    long lines; it stops with an error at a secret, what it has yielded stays."""
    def long_lines(text):
        for at, line in enumerate((text or "").split("\n")):
            if 'token = "' in line:
                raise ValueError(f"secret in line {at}")
            if len(line) > 400:
                yield at, len(line)

    return rows_of_records(t.documents, long_lines, ["text"], "line_no bigint, n_chars bigint", ["doc_id"])
