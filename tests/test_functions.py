"""Naming, text and URL builders: own inputs, results worked out by hand or by plain Python."""

import hashlib

from pyspark.sql import functions as F

from assay.functions import names as N
from assay.functions import text as X
from assay.functions import urls as U
from assay.plans.scalars import duration_label

WORKSPACE = "5550001"


def plain_hash(text, length):
    """md5 as an integer, base 36, least significant digit first."""
    n, out = int(hashlib.md5(text.encode()).hexdigest(), 16), ""
    for _ in range(length):
        n, digit = divmod(n, 36)
        out += "0123456789abcdefghijklmnopqrstuvwxyz"[digit]
    return out


def one(spark, col, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(col).first()
    return row[0]


def test_stable_hash(spark):
    # Parity values: the hashes of two fixed inputs.
    parity = {"mickey.mouse@disney.com9876543210": "g4qd", "donald.duck@disney.com9876543210": "511r"}
    texts = [*parity, "", "a", "ünïcode", "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.a, r.b) for r in df.select("t", N.stable_hash("t", length=4).alias("a"), N.stable_hash("t", length=8).alias("b")).collect()}
    assert got == {t: (plain_hash(t, 4), plain_hash(t, 8)) for t in texts}
    assert {t: got[t][0] for t in parity} == parity
    two = spark.range(1).select(N.stable_hash(F.lit("p"), F.lit(7), length=5)).first()[0]
    assert two == plain_hash("p:7", 5)


def test_unique_and_schema_names(spark):
    user = "Ann-Lee.O_Neil+qa@corp.example"
    h = plain_hash(user + WORKSPACE, 4)
    u, ws = F.lit(user), F.lit(WORKSPACE)
    row = spark.range(1).select(
        N.unique_name(u, F.lit("sql1"), ws, sep="-").alias("a"), N.unique_name(u, F.lit("sql1"), ws, F.lit("Week 3: Joins"), sep="_").alias("b"),
        N.schema_name(u, F.lit("x y"), ws).alias("c"), N.catalog_name(u, ws).alias("d"), N.catalog_name(u, ws, F.lit("No.7")).alias("e")).first()
    assert row.a == f"ann-lee-o-neil-qa-{h}-da-sql1"
    assert row.b == f"ann_lee_o_neil_qa_{h}_da_sql1_week_3_joins"
    assert row.c == f"ann_lee_o_neil_qa_{h}_da_x_y"
    assert row.d == f"ann_lee_o_neil_qa_{h}_da" and row.e == f"ann_lee_o_neil_qa_{h}_da_no_7"


def test_clean_names(spark):
    df = spark.createDataFrame([("Joins (inner/outer) -- v2!",), ("__Ärger & Co__",), (None,)], "n string")
    rows = df.select(N.to_clean_lesson_name("n").alias("a"), N.to_build_name("n").alias("b")).collect()
    assert (rows[0].a, rows[0].b) == ("Joins_inner_outer_v2_", "joins-inner-outer-v2-")
    assert (rows[1].a, rows[1].b) == ("_rger_Co_", "-rger-co-")
    assert rows[2].a is None and rows[2].b is None


LESSONS = [
    ("Appendix", -1), ("7", -1), ("", -1), (" - 4 - x", -1), ("4x - Tables", -1), ("Unit 4b - Tables", -1), ("4 5 - Tables", -1), ("-1 - y", 1),
    ("Unit 04 - Tables/Unit 4.2 - Keys", 4), ("4 - Tables", 4), ("  0017   - Views - more", 17), ("#9 - Z", 9), ("Unit - Tables", -1),
]


def test_lesson_numbers(spark):
    df = spark.createDataFrame(LESSONS, "p string, want int")
    bad = df.where(N.lesson_number("p") != F.col("want")).collect()
    assert bad == []


def test_duration_labels(spark):
    df = spark.createDataFrame([(5_000,), (65_000,), (3_725_000,), (90_061_000,)], "ms long")
    got = [r[0] for r in df.select(duration_label(F.col("ms"))).collect()]
    assert got == ["5s", "1m, 5s", "1h, 2m, 5s", "1h, 1m, 1s"]   # days are dropped


def test_escapes_and_quote(spark):
    row = spark.range(1).select(
        X.html_escape(F.lit("<a href=\"x\">'&'</a>")).alias("h"),
        X.chat_escape(F.lit("a & <b>")).alias("c"),
        X.url_quote(F.lit("a b*~+/é")).alias("q")).first()
    assert row.h == "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&#x27;&lt;/a&gt;"
    assert row.c == "a &amp; &lt;b&gt;"
    assert row.q == "a%20b%2A~%2B%2F%C3%A9"


def test_query_params(spark):
    df = spark.createDataFrame([("https://h/x.dbc?course=c1&version=v2&token=t",), ("course=c&bad",), ("a?b?c",)], "u string")
    p = U.parse_query(F.col("u"), default_base="default")
    rows = df.select(p["valid"].alias("ok"), p["base"].alias("base"), U.param(p["kvs"], "course").alias("c")).collect()
    assert (rows[0].ok, rows[0].base, rows[0].c) == (True, "https://h/x.dbc", "c1")
    assert rows[1].ok is False
    assert rows[2].ok is False


def test_template_and_residual(spark):
    row = spark.range(1).select(
        X.render_template(F.lit("Hi {{who}}, {{left}}"), {"who": "you"}).alias("r")).first()
    assert row.r == "Hi you, {{left}}"
    left = spark.range(1).select(F.size(X.residual_mustaches(F.lit(row.r)))).first()[0]
    assert left == 1


def test_py_strip_handles_unicode_spaces(spark):
    row = spark.range(1).select(X.py_strip(F.lit("  x y \n")).alias("s")).first()
    assert row.s == "x y"
