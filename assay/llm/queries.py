"""Driver queries of the thirteen operators, with DuckDB SQL where it can express
their result.  Each reads the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, exact, htmltext, langid, licenses, mixing, neardup, pieces, pii, quality, search, spelling, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def register(name: str, tables: str, sql: str | None = None):
    """Register ``fn(frame of each whole table) -> DataFrame``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*[spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet") for table in tables.split()])

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_URL_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
_URL_WORDS = ", ".join(f"'{w}'" for w in urls.SUSPECT_WORDS)


@register("op1_url_filter", "pages", f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path
  FROM cut),
rules(verdict, rhost, rpath) AS (VALUES {_URL_RULES}),
fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, host, path, rule, COALESCE(verdict, CASE WHEN list_has_any(
    string_split_regex(host, '[.-]'), [{_URL_WORDS}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (page_id)""")
def op1(pages: DataFrame) -> DataFrame:
    """Verdict on the url of every page by the base rules, else by the words of its host."""
    return urls.filter_urls(pages.select("page_id", "url"), urls.rules_frame(pages.sparkSession)).drop("url")


@register("op7_quality_rules", "documents labels")
def op7(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base rule and compression verdict of every document, by bands fitted to the labels."""
    return quality.quality(documents.select("doc_id", "text"), bands=quality.fit_bands(documents, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op8_byte_bpe", "documents")
def op8(documents: DataFrame) -> DataFrame:
    """Ids of every text, and the bytes they stand for, as digests."""
    done = bpe.encode(documents.select("doc_id", "text"), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, decoded=True)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op9_source_mix", "documents", f"""
WITH s AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^ \\t\\n\\v\\f\\r]+')), 0) AS size,
    md5(COALESCE(source, '') || ':' || COALESCE(doc_id::VARCHAR, '')) AS key
  FROM documents),
src AS (
  SELECT source, SUM(size) AS source_size, [{", ".join(f"{float(w)}::DOUBLE" for w in mixing.WEIGHTS)}][(
    ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
  FROM s GROUP BY source),
r AS (SELECT *, (source_size * {mixing.PASSES})::DOUBLE AS most, most / weight AS ratio FROM src),
l AS (
  SELECT *, (SUM(source_size) OVER () * {mixing.SHARE}::DOUBLE - COALESCE(SUM(most) OVER before, 0.0))
    / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER before, 0.0)) AS level
  FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, CASE WHEN level < ratio THEN MAX(CASE WHEN level < ratio THEN level END) OVER () * weight ELSE most END AS target
  FROM l),
line AS (
  SELECT source, key, size, nth, (SUM(size) OVER (PARTITION BY source, nth ORDER BY key) + nth * source_size)
    / CASE WHEN target > 0 THEN target END AS finish
  FROM s JOIN goal USING (source), generate_series(0, {mixing.PASSES - 1}) AS p(nth)),
spent AS (SELECT *, SUM(size) OVER (ORDER BY finish, source, nth, key) AS spent FROM line WHERE finish <= 2),
upto AS (
  SELECT source, nth, MAX(key) AS upto FROM spent
  WHERE spent <= (SELECT SUM(target) FROM goal) GROUP BY source, nth)
SELECT doc_id, size, source_size, target, size * (SELECT COUNT(*) FROM upto u WHERE u.source = s.source AND s.key <= u.upto) AS taken
FROM s JOIN goal USING (source)""")
def op9(documents: DataFrame) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix_plan(documents).select("doc_id", "size", "source_size", "target", "taken")


@register("op10_exact_dedup", "documents", """
WITH n AS (
  SELECT doc_id, regexp_replace(COALESCE(text, ''), '[ \\t\\n\\v\\f\\r]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, MIN(doc_id) OVER g AS keep_id, COUNT(*) OVER g AS group_size,
  doc_id = MIN(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)""")
def op10(documents: DataFrame) -> DataFrame:
    """The document that stays of each group of equal texts."""
    return exact.exact_dedup(documents)


@register("op2_near_dedup", "documents")
def op2(documents: DataFrame) -> DataFrame:
    """The group of near copies of every document."""
    return neardup.near_dedup(documents)


@register("op3_language_id", "documents")
def op3(documents: DataFrame) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(documents, public_tokenizers.path(BPE_RANKS))


@register("op4_license_scan", "documents")
def op4(documents: DataFrame) -> DataFrame:
    """License phrases and passages in every document."""
    return licenses.scan(documents).drop("spans")


@register("op5_pii", "documents")
def op5(documents: DataFrame) -> DataFrame:
    """Personal data and the terms that reveal it, in every document."""
    found = pii.find(documents)
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in pii.KINDS[:4]],
                        F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


@register("op6_html_text", "pages")
def op6(pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


@register("op11_reversed_search", "documents benchmark", r"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS row, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT row, doc_id, UNNEST(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
i AS (SELECT DISTINCT item_id, UNNEST(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
c AS (SELECT row, doc_id, term, COUNT(*) AS tf FROM t GROUP BY ALL),
l AS (SELECT row, COUNT(*) AS n FROM t GROUP BY row),
total AS (SELECT COUNT(*)::BIGINT AS nn, SUM(n)::BIGINT AS ll FROM l),
w AS (SELECT term, FLOOR(1000 * LN((2 * nn + 2) / (2 * COUNT(*) + 1)))::BIGINT AS w FROM c, total GROUP BY term, nn),
s AS (
  SELECT item_id, row, c.doc_id, SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN c USING (term) JOIN w USING (term) JOIN l USING (row), total GROUP BY ALL)
SELECT item_id, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""")
def op11(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search.search(documents, benchmark)


@register("op12_spelling_variants", "documents")
def op12(documents: DataFrame) -> DataFrame:
    """Every word of the documents with its more frequent spelling."""
    return spelling.variants(documents)


@register("op13_sentence_pieces", "documents")
def op13(documents: DataFrame) -> DataFrame:
    """Ids of every text, and the text they stand for, as digests."""
    done = pieces.encode(documents.select("doc_id", "text"), public_tokenizers.path(PIECES), decoded=True)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
