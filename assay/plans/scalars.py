"""Section 2.8: scalar Column builders exercised over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions import names as N
from assay.functions import text as X
from assay.functions import urls as U
from assay.plans import standins as S
from assay.plans.registry import query

# The placeholder pattern and deprecated icon markers that a
# rendered document must not contain any more.
MUSTACHE_PATTERN = r"\{\{[a-zA-Z\-\\_#/]*\}\}"
DEPRECATED_ICONS = [":HINT:", ":CAUTION:", ":BESTPRACTICE:", ":SIDENOTE:", ":NOTE:"]


def page_titles(t):
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


TITLES_SQL = "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages"


@query("clean_names", f"""
WITH t AS ({TITLES_SQL})
SELECT page_id, title,
  regexp_replace(regexp_replace(title, '[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g') AS lesson_name,
  lower(regexp_replace(regexp_replace(title, '[^a-zA-Z\\p{{Nd}}]', '-', 'g'), '-+', '-', 'g')) AS build_name,
  regexp_replace(lower(translate(title || '.pdf', ': ', '--')), '-+', '-', 'g') AS file_name
FROM t""")
def clean_names(t):
    """Rows 62, 70: clean lesson / build / file names from page titles."""
    p = page_titles(t)
    return p.select("page_id", "title",
                    N.to_clean_lesson_name("title").alias("lesson_name"),
                    N.to_build_name("title").alias("build_name"),
                    N.file_name_from_title("title").alias("file_name"))


def _b36_sql(v: str, length: int) -> str:
    digits = [f"substr('{N.BASE36_DIGITS}', CAST(({v} // {36 ** i}) % 36 AS INTEGER) + 1, 1)" for i in range(length)]
    return " || ".join(digits)


@query("stable_hash", f"""
WITH u AS ({S.USERS_SQL}),
h AS (
  SELECT c_custkey, username,
    CAST((('0x' || md5(username || workspace_id))::UHUGEINT % {36 ** 4}) AS BIGINT) AS v4,
    CAST((('0x' || md5(CAST(c_custkey AS VARCHAR) || ':' || CAST(c_nationkey AS VARCHAR)))::UHUGEINT % {36 ** 6}) AS BIGINT) AS v6
  FROM u)
SELECT c_custkey, username, {_b36_sql('v4', 4)} AS user_hash, {_b36_sql('v6', 6)} AS pair_hash,
  lower(regexp_replace(regexp_replace(split_part(username, '@', 1) || ' ' || ({_b36_sql('v4', 4)}) || ' da asdf skinning cats',
        '[^a-zA-Z\\p{{Nd}}]', '_', 'g'), '_+', '_', 'g')) AS schema_name
FROM h""")
def stable_hash(t):
    """Row 63 (and 64): base-36 md5 hashes and per-user schema names."""
    u = S.users(t)
    return u.select("c_custkey", "username",
                    N.stable_hash(F.concat("username", "workspace_id"), length=4).alias("user_hash"),
                    N.stable_hash("c_custkey", "c_nationkey", length=6).alias("pair_hash"),
                    N.schema_name("username", F.lit("asdf"), F.col("workspace_id"),
                                  F.lit("skinning cats")).alias("schema_name"))


def lesson_paths(t):
    p = t.part
    k = F.col("p_partkey") % 3
    path = (F.when(k == 0, F.concat_ws(" - ", "p_brand", "p_name"))
            .when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit("x - "), F.col("p_type")))
            .otherwise(F.col("p_name")))
    return p.select("p_partkey", path.alias("path"))


@query("lesson_number", """
WITH p AS (
  SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || ' - ' || p_name
                                       WHEN 1 THEN CAST(p_size AS VARCHAR) || 'x - ' || p_type
                                       ELSE p_name END AS path
  FROM part),
s AS (
  SELECT *, regexp_replace(regexp_replace(split_part(path, ' - ', 1), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'),
                           '^[^\\p{Nd}]+', '') AS pre
  FROM p)
SELECT p_partkey, path,
  CAST(CASE WHEN NOT contains(path, ' - ') THEN -1
       WHEN regexp_matches(pre, '^[0-9]+$') THEN TRY_CAST(pre AS BIGINT)
       ELSE -1 END AS BIGINT) AS lesson_number
FROM s""")
def lesson_number(t):
    """Row 65: numeric lesson prefix or -1."""
    p = lesson_paths(t)
    return p.select("p_partkey", "path", N.lesson_number("path").alias("lesson_number"))


def duration_label(ms):
    s = (F.floor(ms / 1000) % 60).cast("bigint")
    m = (F.floor(ms / 60000) % 60).cast("bigint")
    h = (F.floor(ms / 3600000) % 24).cast("bigint")
    return (F.when(h > 0, F.format_string("%dh, %dm, %ds", h, m, s))
            .when(m > 0, F.format_string("%dm, %ds", m, s))
            .otherwise(F.format_string("%ds", s)))


DURATION_LABEL_SQL = """CASE
    WHEN CAST(floor({d} / 3600000) AS BIGINT) % 24 > 0 THEN
      CAST(CAST(floor({d} / 3600000) AS BIGINT) % 24 AS VARCHAR) || 'h, ' || CAST(CAST(floor({d} / 60000) AS BIGINT) % 60 AS VARCHAR) || 'm, ' || CAST(CAST(floor({d} / 1000) AS BIGINT) % 60 AS VARCHAR) || 's'
    WHEN CAST(floor({d} / 60000) AS BIGINT) % 60 > 0 THEN
      CAST(CAST(floor({d} / 60000) AS BIGINT) % 60 AS VARCHAR) || 'm, ' || CAST(CAST(floor({d} / 1000) AS BIGINT) % 60 AS VARCHAR) || 's'
    ELSE CAST(CAST(floor({d} / 1000) AS BIGINT) % 60 AS VARCHAR) || 's' END"""


@query("duration_labels", f"""
WITH d AS (SELECT event_id, CAST(round(value * 360000) AS BIGINT) AS duration_ms FROM events)
SELECT event_id, duration_ms, {DURATION_LABEL_SQL.format(d='duration_ms')} AS label FROM d""")
def duration_labels(t):
    """Row 66: millisecond durations to 'Hh, Mm, Ss' labels (days dropped)."""
    e = t.events.select("event_id", F.round(F.col("value") * 360000).cast("bigint").alias("duration_ms"))
    return e.select("event_id", "duration_ms", duration_label(F.col("duration_ms")).alias("label"))


@query("query_params", """
WITH p AS (SELECT page_id, url, string_split(url, '?') AS parts FROM pages),
q AS (
  SELECT page_id, url, len(parts) AS n,
    CASE WHEN len(parts) = 1 THEN 'default' WHEN len(parts) = 2 THEN parts[1] END AS base_url,
    CASE WHEN len(parts) = 1 THEN parts[1] WHEN len(parts) = 2 THEN parts[2] END AS qs
  FROM p),
k AS (SELECT *, string_split(qs, '&') AS kvs FROM q),
v AS (SELECT *, n <= 2 AND len(list_filter(kvs, lambda x: NOT contains(x, '='))) = 0 AS valid FROM k)
SELECT page_id, valid,
  CASE WHEN valid THEN base_url END AS base_url,
  CASE WHEN valid THEN string_split(list_filter(kvs, lambda x: split_part(x, '=', 1) = 'page')[-1], '=')[2] END AS page_param,
  CASE WHEN valid THEN string_split(list_filter(kvs, lambda x: split_part(x, '=', 1) = 'ref')[-1], '=')[2] END AS ref_param,
  CASE WHEN valid THEN CAST(len(kvs) AS INTEGER) END AS n_params,
  starts_with(url, 'https://') AND len(list_filter(kvs, lambda x: starts_with(x, 'page='))) > 0
    AND len(list_filter(kvs, lambda x: starts_with(x, 'ref='))) > 0 AS url_ok
FROM v""")
def query_params(t):
    """Rows 67, 68: course-spec style URL parsing and URL check."""
    p = t.pages.select("page_id", "url")
    parsed = U.parse_query(F.col("url"), default_base="default")
    return p.select(
        "page_id",
        parsed["valid"].alias("valid"),
        F.when(parsed["valid"], parsed["base"]).alias("base_url"),
        F.when(parsed["valid"], U.param(parsed["kvs"], "page")).alias("page_param"),
        F.when(parsed["valid"], U.param(parsed["kvs"], "ref")).alias("ref_param"),
        F.when(parsed["valid"], F.size(parsed["kvs"])).alias("n_params"),
        U.url_has(F.col("url"), parsed["kvs"], "https://", ["page", "ref"]).alias("url_ok"))


@query("path_parts", f"""
WITH p AS ({S.PAGE_PATHS_SQL}), s AS (SELECT page_id, path, string_split(path, '/') AS parts FROM p)
SELECT page_id, path, parts[-1] AS name, array_to_string(parts[1:len(parts) - 1], '/') AS dir,
  parts[-2] AS parent
FROM s""")
def path_parts(t):
    """Row 69: file name, directory and parent component of each page path."""
    p = S.page_paths(t)
    return p.select("page_id", "path", X.path_name("path").alias("name"),
                    X.path_dir("path", -1).alias("dir"), X.second_last_part("path").alias("parent"))


@query("text_escape", """
WITH e AS (SELECT page_id,
  replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped,
  replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS chat, url_encode(html) AS quoted FROM pages)
SELECT page_id, length(escaped) AS html_len, md5(escaped) AS html_md5, length(chat) AS chat_len, md5(chat) AS chat_md5,
  length(quoted) AS quoted_len, md5(quoted) AS quoted_md5 FROM e""")
def text_escape(t):
    """Row 71: HTML, chat and URL escaping of whole pages (lengths and digests)."""
    html = F.col("html")
    forms = {"html": X.html_escape(html), "chat": X.chat_escape(html), "quoted": X.url_quote(html)}
    e = t.pages.select("page_id", *[c.alias(n) for n, c in forms.items()])
    return e.select("page_id", *[f(n).alias(f"{n}_{k}") for n in forms for k, f in (
        ("len", lambda n: F.length(n).cast("bigint")), ("md5", F.md5))])


TEMPLATE = "[{{role}} #{{turn}}] {{text}} {{missing}} {{ spaced }} :NOTE:"


@query("template_render", f"""
WITH r AS (
  SELECT conv_id, turn,
    replace(replace(replace('{TEMPLATE}', '{{{{role}}}}', role), '{{{{turn}}}}', CAST(turn AS VARCHAR)), '{{{{text}}}}', text) AS rendered
  FROM conversations)
SELECT conv_id, turn, CAST(length(rendered) AS INTEGER) AS rendered_len, md5(rendered) AS rendered_md5,
  CAST(len(regexp_extract_all(rendered, '\\{{\\{{[a-zA-Z\\-\\\\_#/]*\\}}\\}}')) AS INTEGER) AS residual,
  {' OR '.join(f"contains(rendered, '{i}')" for i in DEPRECATED_ICONS)} AS has_icon
FROM r""")
def template_render(t):
    """Row 73: {{key}} substitution from a per-row map, residual placeholders."""
    c = t.conversations
    m = F.create_map(F.lit("role"), F.col("role"), F.lit("turn"), F.col("turn").cast("string"),
                     F.lit("text"), F.col("text"))
    r = c.select("conv_id", "turn", X.render_template_map(F.lit(TEMPLATE), m).alias("rendered"))
    icon = F.lit(False)
    for i in DEPRECATED_ICONS:
        icon = icon | F.col("rendered").contains(i)
    return r.select("conv_id", "turn", F.length("rendered").alias("rendered_len"),
                    F.md5("rendered").alias("rendered_md5"),
                    F.size(F.regexp_extract_all("rendered", F.lit(MUSTACHE_PATTERN), 0)).alias("residual"),
                    icon.alias("has_icon"))


def part_versions(t):
    p = t.part
    v = F.when(F.col("p_partkey") % 10 == 0, F.concat(F.col("p_brand"), F.lit(".1"))).otherwise(
        F.concat_ws(".", F.col("p_size").cast("string"), (F.col("p_partkey") % 100).cast("string"),
                    (F.col("p_partkey") % 7).cast("string")))
    return p.select("p_partkey", "p_brand", v.alias("version"))


PART_VERSIONS_SQL = """
  SELECT p_partkey, p_brand,
    CASE WHEN p_partkey % 10 = 0 THEN p_brand || '.1'
         ELSE CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 100 AS VARCHAR) || '.' || CAST(p_partkey % 7 AS VARCHAR) END AS version
  FROM part"""


@query("version_check", f"""
WITH v AS ({PART_VERSIONS_SQL}), s AS (SELECT *, string_split(version, '.') AS parts FROM v)
SELECT p_partkey, version, CAST(len(parts) AS INTEGER) AS n_parts,
  CASE WHEN len(parts) <> 3 THEN 'parts'
       WHEN NOT regexp_matches(parts[1], '^\\p{{N}}+$') THEN 'major'
       WHEN NOT regexp_matches(parts[2], '^\\p{{N}}+$') THEN 'minor'
       WHEN NOT regexp_matches(parts[3], '^\\p{{N}}+$') THEN 'bug' END AS error
FROM s""")
def version_check(t):
    """Row 74: N.N.N version shape check with the failing part named."""
    v = part_versions(t)
    parts = F.split("version", r"\.", -1)
    num = lambda i: F.try_element_at(parts, F.lit(i)).rlike(r"^\p{N}+$")
    err = (F.when(F.size(parts) != 3, "parts").when(~num(1), "major").when(~num(2), "minor")
           .when(~num(3), "bug"))
    return v.select("p_partkey", "version", F.size(parts).alias("n_parts"), err.alias("error"))


@query("tags_to_entries", """
SELECT event_id, k AS key, CAST(json_extract(props, '$."' || k || '"') AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def tags_to_entries(t):
    """Row 76: a JSON tag object to key/value rows."""
    e = t.events.select("event_id", F.from_json("props", "map<string,bigint>").alias("m"))
    return e.select("event_id", F.explode("m").alias("key", "value"))
