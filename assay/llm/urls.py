"""URL filters by hash-prefix lookup, in DataFrame functions only.

A rule is a host and the start of a path.  A URL is expanded into expressions:
each suffix of its host at a label border, with each leading folder of its
path.  Rules stand under the expression of their host and of the folders in
their path.  URLs and rules meet in an equi-join on the first four bytes of
the expressions' SHA-256; a meeting counts once the full digests agree and the
URL's path starts with the rule's.  The longest rule wins.

URLs that no rule decides are judged by the words of their host's labels
(split at hyphens), looked up among suspect words in the same join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_DIGITS = 8        # hexadecimal digits of the digest that are joined on

#: The base rules as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words in host labels that speak against a URL without a rule.
SUSPECT_WORDS = ("ads", "adult", "bets", "casino", "gambling", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx")


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    values = ", ".join("({})".format(", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in r)) for r in rules)
    if not rules:
        return spark.sql("SELECT '' AS verdict, '' AS host, '' AS path").limit(0)
    return spark.sql(f"SELECT * FROM VALUES {values} AS r(verdict, host, path)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path up to the query; empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^?#]*)", 1)
    host = F.regexp_extract(after, r"(?s)^([^/]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(after, r"(?s)^[^/]*(/.*)$", 1)


def folders(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def expressions(host: Column, path: Column, labels: Column, depth: Column) -> Column:
    """Host suffixes of at most ``labels`` labels, with leading folders of at
    most ``depth`` slashes; those bounds come from the rules, so that nothing
    that could meet a rule is left out."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, labels)),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    pieces = F.split(folders(path), "/")         # a folder ends at each slash
    slashes = F.size(pieces) - 1
    starts = F.transform(F.sequence(F.lit(0), F.least(slashes, depth)),
                         lambda k: F.when(k == 0, F.lit("")).otherwise(
                             F.concat(F.array_join(F.slice(pieces, F.lit(1), F.greatest(k, F.lit(1))), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.concat(h, F.lit(" "), p))))


def words(host: Column) -> Column:
    """Expressions for the words of the labels."""
    return F.transform(F.array_distinct(F.split(host, r"[.-]")), lambda w: F.concat(F.lit("word "), w))


def filter_urls(urls: DataFrame, rules: DataFrame, url: str = "url", suspect=SUSPECT_WORDS) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``; columns that are named so are replaced.

    ``rules``: ``verdict, host, path`` (see ``RULES``), any number of rows; of
    rules of one length, block beats allow.  A null url, or one
    without ``://``, has an empty host and path; only a rule without a host
    label could meet it, so it is allowed.  Repeated urls are judged once and
    each row gets the verdict; no column but ``url`` plays a part.
    """
    spark = urls.sparkSession
    listed = rules.select(
        F.concat("host", F.lit(" "), folders(F.col("path"))).alias("expression"), "verdict",
        F.concat("host", "path").alias("rule"), F.col("path").alias("rule_path"),
        F.size(F.split("host", r"\.")).alias("labels"), (F.size(F.split("path", "/")) - 1).alias("depth"))
    bounds = listed.agg(F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("depth"), F.lit(0))).first()    # two numbers
    if suspect:
        marks = rules_frame(spark, [("block", "word " + w, "") for w in suspect]).select(
            F.col("host").alias("expression"), "verdict", F.lit(None).cast("string").alias("rule"), F.lit("").alias("rule_path"))
        listed = listed.drop("labels", "depth").unionByName(marks)
    digest = F.sha2("expression", 256)
    listed = listed.select(digest.alias("rule_digest"), "verdict", "rule", "rule_path",
                           F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"))

    host, path = host_and_path(F.col(f"`{url}`"))
    rest = [F.col(f"`{c}`") for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    row = F.struct(*rest) if rest else F.lit(None)
    parsed = urls.select(row.alias("row"), host.alias("host"), path.alias("path"))
    once = parsed.select("host", "path").distinct()
    met = (once.select("host", "path", F.explode(F.concat(
        expressions(F.col("host"), F.col("path"), F.lit(bounds[0]), F.lit(bounds[1])), words(F.col("host")))).alias("expression"))
        .withColumn("digest", digest).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .join(listed, "prefix")
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith(F.col("path"), F.col("rule_path"))))
    # Any rule beats any word; longer beats shorter, of one length block beats allow.
    rank = F.struct(F.col("rule").isNotNull(), F.coalesce(F.length("rule"), F.lit(0)), F.col("verdict") == "block", "rule")
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best"))
    return (parsed.join(best, ["host", "path"], "left")
            .select(*["row.*"] * bool(rest), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit("allow")).alias("verdict")))
