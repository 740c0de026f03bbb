"""Family T: corpus jobs over documents, conversations (as notebooks) and
pages (rows 10, 21, 30, 39, 49-52, 105, 109-122)."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.text import WS, py_strip, tail
from assay.operators import corpus as K
from assay.operators import manifest as M
from assay.plans import standins as S
from assay.plans.corpus_sql import COMMANDS_SQL, DIRECTIVES_SQL, directive_messages_sql, lst, strip
from assay.plans.registry import query

col = F.col
NL = "\n"


# ------------------------------------------------------------------ stand-ins

def cells(t):
    """conversations -> notebook cells: doc = conversation, pos = turn."""
    c = t.conversations
    lang = (F.when(col("conv_id") % 4 == 0, "python").when(col("conv_id") % 4 == 1, "sql")
            .when(col("conv_id") % 4 == 2, "scala").otherwise("r"))
    cm = F.element_at(F.array(*[F.lit(K.COMMENT_MARKERS[x]) for x in ("python", "sql", "scala", "r")]),
                      (col("conv_id") % 4 + 1).cast("int"))
    return c.select(col("conv_id").alias("doc_id"), col("turn").cast("bigint").alias("pos"), "role", "text",
                    lang.alias("language"), cm.alias("cm"))


def commands(t):
    """Cells with directive headers: user -> TODO (body commented out),
    assistant -> ANSWER, system -> SOURCE_ONLY, plus injected variants
    (header directive, double-commented TODO, hyphenated name)."""
    c = cells(t)
    k = col("doc_id") + col("pos")
    cm = col("cm")
    header = (F.when(k % 13 == 0, F.concat(cm, F.lit(" WIP-NOTE")))
              .when((col("role") == "user") & (k % 7 == 0), F.concat(cm, F.lit(" "), cm, F.lit(" TODO")))
              .when(col("role") == "user", F.concat(cm, F.lit(" TODO")))
              .when(col("role") == "assistant", F.concat(cm, F.lit(" ANSWER")))
              .otherwise(F.concat(cm, F.lit(" SOURCE_ONLY"))))
    pre = (F.when(k % 11 == 0, F.concat(cm, F.lit(" INCLUDE_HEADER_TRUE\n")))
           .when(k % 11 == 5, F.concat(cm, F.lit(" INCLUDE_FOOTER_TRUE\n"))).otherwise(F.lit("")))
    body = F.when(col("role") == "user",
                  F.array_join(F.transform(F.split("text", NL, -1), lambda l: F.concat(cm, F.lit(" "), l)), NL)
                  ).otherwise(col("text"))
    # some python / R TODO cells are SQL magic cells: '# MAGIC %sql', '# MAGIC -- TODO', '# MAGIC -- <line>'
    magic = (col("role") == "user") & (k % 5 == 0) & (cm == "#")
    magic_body = F.concat(cm, F.lit(" MAGIC %sql\n"), cm, F.lit(" MAGIC -- TODO\n"),
                          F.array_join(F.transform(F.split("text", NL, -1),
                                                   lambda l: F.concat(cm, F.lit(" MAGIC -- "), l)), NL))
    # some source-only cells end with their own language's magic (a lint warning)
    own = F.when((col("role") == "system") & (k % 3 == 0),
                 F.concat(F.lit(NL), cm, F.lit(" MAGIC %"), col("language"), F.lit(" x"))).otherwise(F.lit(""))
    return c.withColumn("command", F.when(magic, F.concat(pre, magic_body))
                        .otherwise(F.concat(pre, header, F.lit(NL), body, own)))


def directive_cells(t):
    """commands + comments, directives, n_main, errors, warnings."""
    return K.with_directives(K.with_leading_comments(commands(t)))


def _todo_prefix_sql(cmd: str = "command") -> tuple[str, str]:
    """(first, prefix) of the TODO cleaning: a magic first line is kept and
    the prefix becomes '<cm> MAGIC <marker>' (last matching magic wins)."""
    l0 = f"string_split({cmd}, chr(10))[1]"
    many = f"len(string_split({cmd}, chr(10))) > 1"
    first, prefix = "0", "cm"
    for m, mk in [("%r", "#"), ("%md", "--"), ("%sql", "--"), ("%python", "#"), ("%scala", "//")]:
        hit = f"({many} AND (starts_with({l0}, '{m}') OR starts_with({l0}, cm || ' MAGIC {m}')))"
        first = f"CASE WHEN {hit} THEN 1 ELSE {first} END"
        prefix = f"CASE WHEN {hit} THEN cm || ' MAGIC {mk}' ELSE {prefix} END"
    return first, prefix


def _clean_todo_lines_sql(cmd: str = "command") -> str:
    """list of struct(line, err) for the TODO cleaning."""
    first, prefix = _todo_prefix_sql(cmd)
    keep = f"(i = 1 AND ({first}) = 1)"
    err = (f"(CASE WHEN {keep} THEN 0 WHEN i - 1 = ({first}) AND {strip('line')} <> ({prefix}) || ' TODO' THEN 1 "
           f"WHEN NOT starts_with(line, {prefix}) AND {strip('line')} <> '' AND {strip('line')} <> cm || ' MAGIC' THEN 1 "
           f"ELSE 0 END)")
    out = (f"CASE WHEN {keep} THEN line WHEN {err} = 1 THEN '' "
           f"WHEN starts_with({strip('line')}, ({prefix}) || ' TODO') THEN line "
           f"WHEN {strip('line')} = '' OR {strip('line')} = cm || ' MAGIC' THEN line "
           f"WHEN starts_with({strip('line')}, ({prefix}) || ' ') THEN substr(line, length({prefix}) + 2) "
           f"ELSE substr(line, length({prefix}) + 1) END")
    return f"list_transform(string_split({cmd}, chr(10)), lambda line, i: {{'line': {out}, 'err': {err}}})"


def _clean_todo_text_sql(cmd: str = "command") -> str:
    return f"array_to_string(list_transform({_clean_todo_lines_sql(cmd)}, lambda r: r.line), chr(10))"


# ------------------------------------------------------------------- cells

@query("split_cells", """
SELECT doc_id, CAST(u.pos - 1 AS INTEGER) AS pos, CAST(length(u.cell) AS INTEGER) AS n_chars,
  CASE lang WHEN 'en' THEN '#' WHEN 'fr' THEN '--' WHEN 'de' THEN '//' ELSE '#' END AS marker
FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(cell, pos)""")
def split_cells(t):
    """Row 109: a document split into ordered cells on its delimiter (here
    the newline), with the comment marker of the document language."""
    d = t.documents.select("doc_id", "lang", "text")
    lang = (F.when(col("lang") == "en", "python").when(col("lang") == "fr", "sql")
            .when(col("lang") == "de", "scala").otherwise("r"))
    x = d.select("doc_id", K.comment_marker(lang).alias("marker"),
                 F.posexplode(F.split("text", NL, -1)).alias("pos", "cell"))
    return x.select("doc_id", "pos", F.length("cell").alias("n_chars"), "marker")


@query("extract_directives", f"""
WITH d AS ({DIRECTIVES_SQL})
SELECT doc_id, pos, CAST(len(comments) AS INTEGER) AS n_comments, array_to_string(directives, ',') AS directives,
  CAST(n_main AS INTEGER) AS n_main, CAST(n_double + CASE WHEN n_main > 1 THEN 1 ELSE 0 END AS INTEGER) AS errors,
  CAST(n_warn AS INTEGER) AS warnings,
  array_to_string(list_transform({directive_messages_sql()}, lambda m: 'Cmd #' || (pos + 1) || ' | ' || m), chr(10)) AS messages
FROM d""")
def extract_directives(t):
    """Row 110: leading comments of each cell and the directives among them,
    with double-comment errors and hyphen / unsupported warnings."""
    c = directive_cells(t)
    msgs = F.transform("messages", lambda m: F.concat(F.lit("Cmd #"), (col("pos") + 1).cast("string"), F.lit(" | "), m))
    return c.select("doc_id", "pos", F.size("comments").alias("n_comments"),
                    F.array_join("directives", ",").alias("directives"), "n_main", "errors", "warnings",
                    F.array_join(msgs, "\n").alias("messages"))


@query("route_cells", f"""
WITH d AS ({DIRECTIVES_SQL}),
r AS (SELECT doc_id, pos, CASE
        WHEN {strip('command')} = '' THEN []
        WHEN list_has_any(directives, ['SOURCE_ONLY', 'INCLUDE_HEADER_TRUE', 'INCLUDE_HEADER_FALSE', 'INCLUDE_FOOTER_TRUE', 'INCLUDE_FOOTER_FALSE']) THEN []
        WHEN list_contains(directives, 'TODO') THEN ['student']
        WHEN list_contains(directives, 'ANSWER') THEN ['solution']
        ELSE ['student', 'solution'] END AS targets FROM d)
SELECT doc_id, pos, unnest(targets) AS target FROM r""")
def route_cells(t):
    """Row 111: each cell routed to the student and/or solution output by
    its directive; empty, source-only and header/footer cells are skipped."""
    c = directive_cells(t)
    return c.select("doc_id", "pos", F.explode(K.route(col("command"), col("directives"))).alias("target"))


@query("uncomment_todo", f"""
WITH d AS ({DIRECTIVES_SQL}),
td AS (SELECT doc_id, pos, cm, command FROM d WHERE list_contains(directives, 'TODO')),
o AS (SELECT doc_id, pos, {{CLEAN}} AS res FROM td)
SELECT doc_id, pos, CAST(list_sum(list_transform(res, lambda r: r.err)) AS INTEGER) AS errors,
  md5(array_to_string(list_transform(res, lambda r: r.line), chr(10))) AS cleaned_md5,
  CAST(length(array_to_string(list_transform(res, lambda r: r.line), chr(10))) AS INTEGER) AS cleaned_len FROM o""".replace(
    "{CLEAN}", _clean_todo_lines_sql()))
def uncomment_todo(t):
    """Row 112: TODO cells uncommented for the student output, with the
    position checks (directive first, every other line commented)."""
    c = K.with_clean_todo(directive_cells(t).drop("errors"))
    # keep TODO cells by exploding a one- or zero-element array: a filter on
    # the derived directives would be pushed below the projections and
    # recompute the whole comment pipeline inside the scan filter
    row = F.struct("doc_id", "pos", col("todo_errors").alias("errors"), F.md5("cleaned").alias("cleaned_md5"),
                   F.length("cleaned").alias("cleaned_len"))
    keep = F.when(F.array_contains("directives", K.D_TODO), F.array(row)).otherwise(F.array().cast(
        "array<struct<doc_id:bigint,pos:bigint,errors:int,cleaned_md5:string,cleaned_len:int>>"))
    return c.select(F.inline(keep))


@query("magic_lint", f"""
WITH c AS ({COMMANDS_SQL}),
w AS (
  SELECT doc_id, pos, 'Cmd #' || (pos + 1) || ' | Found "%python" in a Python notebook' AS warning FROM c
    WHERE language = 'python' AND NOT starts_with(command, cm || ' MAGIC %md') AND contains(command, '%python')
  UNION ALL SELECT doc_id, pos, 'Cmd #' || (pos + 1) || ' | Found "%sql" in a SQL notebook' FROM c
    WHERE language = 'sql' AND NOT starts_with(command, cm || ' MAGIC %md') AND contains(command, '%sql')
  UNION ALL SELECT doc_id, pos, 'Cmd #' || (pos + 1) || ' | Found "%scala" in a Scala notebook' FROM c
    WHERE language = 'scala' AND NOT starts_with(command, cm || ' MAGIC %md') AND contains(command, '%scala')
  UNION ALL SELECT doc_id, pos, 'Cmd #' || (pos + 1) || ' | Found "%r" in an R notebook' FROM c
    WHERE language = 'r' AND NOT starts_with(command, cm || ' MAGIC %md') AND contains(command, '%r ')
  UNION ALL SELECT doc_id, pos, 'Cmd #' || (pos + 1) || ' | Found "%r" in an R notebook' FROM c
    WHERE language = 'r' AND NOT starts_with(command, cm || ' MAGIC %md') AND contains(command, '%r' || chr(10)))
SELECT * FROM w""")
def magic_lint(t):
    """Row 113: cells (other than markdown) that use their own notebook
    language's magic, with the reference's warning text."""
    return K.magic_findings(commands(t)).select("doc_id", "pos", "warning")


# Tokens a published text must not contain (the reference's
# list with its missing comma, which fuses R_ONLY and VIDEO), the licence
# phrases flagged as well, and the copyright holder of the year check.
FORBIDDEN_TOKENS = ["IPYTHON_ONLY", "AMAZON_ONLY", "AZURE_ONLY", "TEST", "PRIVATE_TEST", "INSTRUCTOR_NOTE",
                    "INSTRUCTOR_ONLY", "SCALA_ONLY", "PYTHON_ONLY", "SQL_ONLY", "R_ONLYVIDEO", "ILT_ONLY",
                    "SELF_PACED_ONLY", "INLINE", "NEW_PART", "{dbr}"]
FLAGGED_PHRASES = ["GNU General Public License", "CC BY-NC"]
COPYRIGHT_HOLDER = "Example, Inc"
YEAR_PATTERN = r"(20(?:1[7-9]|[2-9][0-9])|2[1-8][0-9]{2}|29[0-8][0-9]|299[0-8])"


@query("forbidden_tokens", f"""
WITH d AS (SELECT doc_id, text FROM documents),
tok AS (SELECT * FROM (VALUES {', '.join(f"('{x}')" for x in FORBIDDEN_TOKENS + FLAGGED_PHRASES)}) v(token))
SELECT doc_id, token FROM d, tok WHERE contains(d.text, tok.token)
UNION ALL
SELECT DISTINCT doc_id, y || ' {COPYRIGHT_HOLDER}' FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '{YEAR_PATTERN} {COPYRIGHT_HOLDER}', 1)) AS y FROM d)""")
def forbidden_tokens(t):
    """Row 113: forbidden tokens, flagged licence phrases and copyright
    years 2017-2998 found in each document (one finding per token)."""
    d = t.documents.select("doc_id", "text")
    # (outer: a plain explode puts a filter on the array before the scan, which makes it twice)
    return d.select("doc_id", F.explode_outer(token_hits(col("text"))).alias("token")).where("token is not null")


def token_hits(text):
    """Forbidden tokens, flagged phrases and copyright tags found in a text."""
    # a literal search each: far cheaper than one pattern of all of them
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(x)), F.lit(x)) for x in FORBIDDEN_TOKENS + FLAGGED_PHRASES]))
    years = F.when(F.instr(text, f" {COPYRIGHT_HOLDER}") > 0, F.array_distinct(
        F.regexp_extract_all(text, F.lit(f"{YEAR_PATTERN} {COPYRIGHT_HOLDER}"), 1))).otherwise(
        F.array().cast("array<string>"))
    return F.concat(found, F.transform(years, lambda y: F.concat(y, F.lit(f" {COPYRIGHT_HOLDER}"))))


# Literals a source document must not use (parameters).
PROHIBITED = ['token = "', "password", "/dbfs/"]
SOURCE_LANGS = ["en", "fr", "de"]


@query("prohibited_lines", f"""
WITH d AS (SELECT doc_id, text FROM documents WHERE lang IN {lst(SOURCE_LANGS)}),
w AS (SELECT * FROM (VALUES {', '.join("('" + x.replace("'", "''") + "')" for x in PROHIBITED)}) v(what)),
h AS (SELECT doc_id, what, text, instr(text, what) AS p FROM d, w WHERE instr(text, what) > 0)
SELECT doc_id, what, line, 'Cmd #1 | Course includes prohibited use of ' || what || ':' || chr(10) || '| ' || line AS message
FROM (SELECT doc_id, what, {strip("split_part(substr(text, 1, p - 1), chr(10), -1) || split_part(substr(text, p), chr(10), 1)")} AS line
      FROM h)""")
def prohibited_lines(t):
    """Row 114: for each prohibited literal, the stripped line of its first
    occurrence in a source-language document."""
    d = t.documents.where(col("lang").isin(SOURCE_LANGS)).select("doc_id", "text")
    x = d.select("doc_id", F.explode(prohibited_hits(col("text"))).alias("h"))
    # a document is one cell: the reference's message template, numbered Cmd #1
    msg = F.concat(F.lit("Cmd #1 | Course includes prohibited use of "), col("h.what"), F.lit(":\n| "), col("h.line"))
    return x.where(col("h.line").isNotNull()).select("doc_id", col("h.what").alias("what"), col("h.line").alias("line"),
                                                     msg.alias("message"))


def prohibited_hits(text):
    """(what, first line holding it or NULL) for every prohibited literal."""
    return F.array(*[F.struct(F.lit(w).alias("what"), K.line_of_first(text, w).alias("line")) for w in PROHIBITED])


HREF_PATTERN = "^/[a-z]"  # second, parameterised link rule (lower-case slug)


@query("html_link_lint", f"""
SELECT page_id, CAST(u.i - 1 AS INTEGER) AS link_no, u.link,
  NOT contains(u.link, 'target="_blank"') AS missing_target,
  NOT regexp_matches(regexp_extract(u.link, 'href="([^"]*)"', 1), '{HREF_PATTERN}') AS bad_href,
  CASE WHEN NOT contains(u.link, 'target="_blank"')
       THEN 'Cmd #1 | Found HTML link without the required target="_blank": ' || u.link END AS message
FROM pages, unnest(regexp_extract_all(html, '<a .*?</a>')) WITH ORDINALITY AS u(link, i)""")
def html_link_lint(t):
    """Row 115: HTML links lacking target="_blank", and links whose href
    breaks a parameterised pattern."""
    p = t.pages.select("page_id", F.posexplode(K.html_links(col("html"))).alias("link_no", "link"))
    href = F.regexp_extract("link", 'href="([^"]*)"', 1)
    missing = ~col("link").contains('target="_blank"')
    msg = F.when(missing, F.concat(F.lit('Cmd #1 | Found HTML link without the required target="_blank": '), col("link")))
    return p.select("page_id", "link_no", "link", missing.alias("missing_target"),
                    (~href.rlike(HREF_PATTERN)).alias("bad_href"), msg.alias("message"))


def markdown_pages(t):
    """pages with each anchor rewritten as a relative markdown link
    ``[text]($.href)`` (and every fifth page's first link as an image)."""
    p = t.pages.select("page_id", "html")
    md = F.regexp_replace("html", '<a href="([^"]*)">([^<]*)</a>', r"[$2](\$.$1)")
    md = F.when(col("page_id") % 5 == 0, F.regexp_replace(md, r"^(.*?)\[", "$1![")).otherwise(md)
    return p.select("page_id", md.alias("md"))


# The paths of all pages, each with its folders, as link targets may name them.
_KNOWN_PAGES_SQL = f"""
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS known
  FROM (SELECT string_split(regexp_replace(substr(path, 2), '/+$', ''), '/') AS parts FROM ({S.PAGE_PATHS_SQL})), unnest(range(1, len(parts) + 1)) AS u(i)"""


def _resolve_sql(path: str, target: str) -> str:
    """``resolve_target`` for paths that have folders."""
    climbs = f"CAST(length(regexp_extract({target}, '^((\\.\\./)*)', 1)) / 3 AS INTEGER)"
    rest = (f"CASE WHEN starts_with({target}, '../') THEN substr({target}, 3 * {climbs} + 1) "
            f"WHEN starts_with({target}, './') THEN substr({target}, 3) ELSE {target} END")
    parent = f"array_to_string(string_split({path}, '/')[1:greatest(len(string_split({path}, '/')) - 1 - {climbs}, 0)], '/')"
    return f"regexp_replace({parent} || '/' || {rest}, '^/', '')"


def page_notebooks(t):
    """Every page as a notebook at ``host/folders/name``."""
    return S.page_paths(t).select("page_id", F.regexp_replace(tail("path", 2), "/+$", "").alias("path"))


@query("md_link_lint", rf"""
WITH m AS (SELECT page_id, regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '[\2]($.\1)', 'g') AS md FROM pages),
m2 AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_replace(md, '^(.*?)\[', '\1![') ELSE md END AS md FROM m),
l AS (SELECT page_id, unnest(regexp_extract_all(md, '!?\[.*?\]\(.*?\)')) AS link FROM m2),
r AS (SELECT page_id, link, regexp_extract(link, '\(\$.*\)') AS rel FROM l WHERE NOT starts_with(link, '!')),
p AS (SELECT page_id, regexp_replace(substr(path, 2), '/+$', '') AS path FROM ({S.PAGE_PATHS_SQL})),
x AS (SELECT page_id, link, substr(rel, 3, length(rel) - 3) AS target, path FROM r JOIN p USING (page_id) WHERE rel <> ''),
y AS (SELECT *, {_resolve_sql('path', 'target')} AS resolved FROM x)
SELECT page_id, link, target, resolved, CASE WHEN k.known IS NULL THEN 'error' END AS severity,
  CASE WHEN k.known IS NULL THEN 'Cmd #1 | Cannot find notebook for the MD link target: "$' || target || '" resolved as "' || resolved || '"' END AS message
FROM y LEFT JOIN ({_KNOWN_PAGES_SQL}) k ON k.known = y.resolved""")
def md_link_lint(t):
    """Row 116: markdown links (not images, via look-behind) whose target is
    relative (``($...)``), resolved from the page's folder and looked up among
    all pages and folders.  (The oracle, lacking look-behind in RE2, matches
    an optional '!' and drops those.)"""
    m = markdown_pages(t)
    links = m.select("page_id", F.explode(F.regexp_extract_all("md", F.lit(r"(?<!!)\[.*?\]\(.*?\)"), 0)).alias("link"))
    rel = F.regexp_extract("link", r"\(\$.*\)", 0)
    links = (links.where(rel != "").select("page_id", "link", F.regexp_replace(tail(rel, 2), r"\)$", "").alias("original"))
             .select("*", tail("original", 2).alias("target"), F.lit(0).alias("pos")).join(page_notebooks(t), "page_id"))
    return K.check_targets(links, page_notebooks(t), "MD link").select("page_id", "link", "target", "resolved", "severity", "message")


def run_cells(t):
    """A %run / %pip cell per conversation turn with quoting variants."""
    c = cells(t)
    k = col("doc_id") + col("pos")
    target = F.concat(F.lit("../Includes/Setup-"), col("doc_id").cast("string"))
    run = (F.when(k % 3 == 0, F.concat(F.lit('"'), target, F.lit(' x"')))
           .when(k % 3 == 1, F.concat(target, F.lit(" $arg=1")))
           .otherwise(F.concat(F.lit('"'), target)))
    repo = lambda k: F.element_at(F.array(*[F.lit(r) for r in BANNED_REPOS + [CURRENT_REPO]]),
                                  (k % (len(BANNED_REPOS) + 1) + 1).cast("int"))
    cmd = F.when(col("role") == "user", F.concat(col("cm"), F.lit(" MAGIC %run "), run)).otherwise(
        F.concat(col("cm"), F.lit(f" MAGIC %pip install git+{REPO_BASE}"), repo(col("pos")),
                 F.when(col("pos") % 3 == 0, F.concat(F.lit(f" git+{REPO_BASE}"), repo(col("pos") + 1))).otherwise("")))
    return c.select("doc_id", "pos", "cm", notebook_path(col("doc_id")).alias("path"), cmd.alias("command"))


def notebook_path(doc_id):
    return F.concat(F.lit("Course-"), (doc_id % 10).cast("string"), F.lit("/Nb-"), doc_id.cast("string"))


def notebook_paths(t):
    """All notebooks: one for each conversation, and a setup for two in three."""
    ids = t.conversations.select(col("conv_id").alias("doc_id")).distinct()
    setup = F.when(col("doc_id") % 3 != 0, F.concat(F.lit("Includes/Setup-"), col("doc_id").cast("string")))
    return ids.select(F.explode(F.array_compact(F.array(notebook_path(col("doc_id")), setup))).alias("path"))


# Messages, and retired library repositories a %pip cell must not install.
RUN_UNCLOSED = "Cmd #{n} | Missing closing quote in %run target"
PIP_RETIRED = "Cmd #{n} | Using unsupported repo, {repo} is no longer supported; please use {current} instead."
BANNED_REPOS = ["helper-lib", "rest-lib", "gems-lib", "courseware-lib"]
REPO_BASE = "https://example.org/"
CURRENT_REPO = "current-lib"


def _repo_sql(k):
    cases = " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(BANNED_REPOS))
    return f"CASE ({k}) % {len(BANNED_REPOS) + 1} {cases} END"


@query("run_targets", f"""
WITH c AS (SELECT conv_id AS doc_id, CAST(turn AS BIGINT) AS pos, role FROM conversations),
t AS (SELECT doc_id, pos, CASE (doc_id + pos) % 3 WHEN 0 THEN '../Includes/Setup-' || doc_id || ' x' WHEN 1 THEN '../Includes/Setup-' || doc_id END AS target
      FROM c WHERE role = 'user'),
r AS (SELECT *, substr(target, 4) AS resolved, target = '../Includes/Setup-' || doc_id AND doc_id % 3 <> 0 AS found FROM t),
b AS (SELECT doc_id, pos, {_repo_sql('pos')} AS repo FROM c WHERE role <> 'user'
      UNION ALL SELECT doc_id, pos, {_repo_sql('pos + 1')} FROM c WHERE role <> 'user' AND pos % 3 = 0)
SELECT doc_id, pos, 'run' AS kind, target, resolved,
  CASE WHEN target IS NULL THEN 'warning' WHEN NOT found THEN 'error' END AS severity,
  CASE WHEN target IS NULL THEN 'Cmd #' || (pos + 1) || ' | Missing closing quote in %run target'
       WHEN NOT found THEN 'Cmd #' || (pos + 1) || ' | Cannot find notebook for the %run target: "' || target || '" resolved as "' || resolved || '"' END AS message
FROM r
UNION ALL
SELECT DISTINCT doc_id, pos, 'pip', NULL, NULL, 'error', 'Cmd #' || (pos + 1) || ' | Using unsupported repo, {REPO_BASE}' || repo ||
  ' is no longer supported; please use {REPO_BASE}{CURRENT_REPO} instead.'
FROM b WHERE repo IS NOT NULL""")
def run_targets(t):
    """Row 117: %run targets (quoted, or up to the first space; a missing
    closing quote is a warning) resolved and looked up among all notebooks,
    and an error for each retired repository that a %pip cell installs."""
    c = run_cells(t)
    prefix = F.concat(col("cm"), F.lit(" MAGIC %run"))
    line0 = F.substring_index("command", NL, 1)
    link = py_strip(tail(line0, F.length(prefix) + 1))
    quoted = link.startswith('"')
    rest = tail(link, 2)
    qpos = F.instr(rest, '"')
    spos = F.instr(link, " ")
    target = (F.when(quoted & (qpos > 0), F.substring(rest, F.lit(1), qpos - 1))
              .when(quoted, F.lit(None))
              .when(spos > 1, F.substring(link, F.lit(1), spos - 1)).otherwise(link))
    runs = c.where(col("command").startswith(prefix)).select("doc_id", "pos", "path", target.alias("target"))
    runs = K.check_targets(runs.withColumn("original", col("target")), notebook_paths(t), "%run")
    unclosed = col("target").isNull()
    runs = runs.select("doc_id", "pos", F.lit("run").alias("kind"), "target", "resolved",
                       F.when(unclosed, "warning").otherwise(col("severity")).alias("severity"),
                       F.when(unclosed, K.fill(RUN_UNCLOSED, n=col("pos") + 1)).otherwise(col("message")).alias("message"))
    found = F.array_compact(F.array(*[F.when(F.contains("command", F.lit(REPO_BASE + r)), K.fill(
        PIP_RETIRED, n=col("pos") + 1, repo=F.lit(REPO_BASE + r), current=F.lit(REPO_BASE + CURRENT_REPO))) for r in BANNED_REPOS]))
    pips = (c.where(col("command").startswith(F.concat(col("cm"), F.lit(" MAGIC %pip"))))
            .select("doc_id", "pos", F.explode(found).alias("message")))
    none = F.lit(None).cast("string")
    return runs.unionByName(pips.select("doc_id", "pos", F.lit("pip").alias("kind"), none.alias("target"), none.alias("resolved"),
                                        F.lit("error").alias("severity"), "message"))


# ------------------------------------------------------------ i18n and bundles

def md_cells(t):
    """assistant turns as markdown cells whose first line carries the i18n
    guid, with injected faults (missing guid, extra word, repeated guid)."""
    c = cells(t).where(col("role") == "assistant")
    k = col("doc_id") + col("pos")
    guid = F.concat(F.lit("--i18n-"), col("doc_id").cast("string"), F.lit("-"), col("pos").cast("string"))
    dup = F.concat(F.lit("--i18n-"), col("doc_id").cast("string"), F.lit("-"), (col("pos") - 2).cast("string"))
    tag = (F.when(k % 9 == 0, F.lit(""))
           .when(k % 10 == 0, F.concat(F.lit(" "), guid, F.lit(" extra")))
           .when(col("pos") % 4 == 3, F.concat(F.lit(" "), dup))
           .otherwise(F.concat(F.lit(" "), guid)))
    cmd = F.concat(col("cm"), F.lit(" MAGIC %md"), tag, F.lit(NL), col("text"))
    # some cells carry the guid in a title line instead (one with an extra word)
    title = F.concat(col("cm"), F.lit(" DBTITLE 1, "), guid, F.when(k % 24 == 1, F.lit(" extra")).otherwise(F.lit("")))
    titled = F.concat(title, F.lit(NL), col("cm"), F.lit(" MAGIC %md"), F.lit(NL), col("text"))
    return c.select("doc_id", "pos", "cm", F.when(k % 8 == 1, titled).otherwise(cmd).alias("command"))


_MD_CELLS_SQL = """
SELECT doc_id, pos, cm, CASE WHEN (doc_id + pos) % 8 = 1
    THEN cm || ' DBTITLE 1, --i18n-' || doc_id || '-' || pos || CASE WHEN (doc_id + pos) % 24 = 1 THEN ' extra' ELSE '' END
         || chr(10) || cm || ' MAGIC %md' || chr(10) || text
    ELSE cm || ' MAGIC %md' || tag || chr(10) || text END AS command
FROM (
  SELECT conv_id AS doc_id, CAST(turn AS BIGINT) AS pos,
    CASE conv_id % 4 WHEN 0 THEN '#' WHEN 1 THEN '--' WHEN 2 THEN '//' ELSE '#' END AS cm, text,
    CASE WHEN (conv_id + turn) % 9 = 0 THEN ''
         WHEN (conv_id + turn) % 10 = 0 THEN ' --i18n-' || conv_id || '-' || turn || ' extra'
         WHEN turn % 4 = 3 THEN ' --i18n-' || conv_id || '-' || (turn - 2)
         ELSE ' --i18n-' || conv_id || '-' || turn END AS tag
  FROM conversations WHERE role = 'assistant')"""


def _guid_check_sql(src: str) -> str:
    """(doc_id, pos, cm, command) -> + titled, title, line0, parts, tw, md, guid, error0."""
    nl = "position(chr(10) IN command)"
    body = (f"CASE WHEN titled THEN {strip(f'CASE WHEN {nl} > 0 THEN substr(command, {nl} + 1) ELSE left(command, 0) END')} "
            f"ELSE command END")
    return f"""
SELECT *, CASE WHEN NOT md THEN NULL WHEN titled THEN (CASE WHEN tg <> '' THEN tg END)
               WHEN len(parts) >= 2 THEN {strip('parts[2]')} END AS guid,
  CASE WHEN NOT md THEN NULL
       WHEN titled THEN (CASE WHEN len(tparts) = 1 OR tg = '' THEN 'no_title' WHEN tw <> 1 THEN 'title_words'
                              WHEN NOT starts_with(tg, '--i18n-') THEN 'title_prefix' END)
       WHEN len(lines) <= 1 THEN 'single_line' WHEN len(parts) = 1 THEN 'missing_directive'
       WHEN len(parts) <> 2 THEN 'word_count' WHEN parts[1] NOT IN ('%md', '%md-sandbox') THEN 'md_tag'
       WHEN NOT starts_with({strip('parts[2]')}, '--i18n-') THEN 'guid_prefix' END AS error0
FROM (
  SELECT *, list_filter(string_split({strip('line0')}, ' '), lambda x: {strip('x')} <> '') AS parts,
    string_split(title, ',') AS tparts, {strip("string_split(title, ',')[2]")} AS tg,
    len(string_split({strip("string_split(title, ',')[2]")}, ' ')) AS tw
  FROM (
    SELECT *, substr(lines[1], length(cm) + 8) AS line0 FROM (
      SELECT *, string_split({strip('body')}, chr(10)) AS lines, starts_with(body, cm || ' MAGIC %md') AS md FROM (
        SELECT *, {body} AS body FROM (
          SELECT *, starts_with(command, cm || ' DBTITLE ') AS titled,
            CASE WHEN starts_with(command, cm || ' DBTITLE ') THEN {strip('split_part(command, chr(10), 1)')} END AS title
          FROM ({src}))))))"""


def _guid_msg_sql():
    return """CASE error
      WHEN 'single_line' THEN 'Cmd #' || (pos + 1) || ' | Expected MD to have more than 1 line of code with i18n enabled: ' || line0
      WHEN 'missing_directive' THEN 'Cmd #' || (pos + 1) || ' | Missing the i18n directive: ' || line0
      WHEN 'word_count' THEN 'Cmd #' || (pos + 1) || ' | Expected the first line of MD to have only two words, found ' || len(parts) || ': ' || line0
      WHEN 'md_tag' THEN 'Cmd #' || (pos + 1) || ' | Expected word[0] of the first line of MD to be "%md" or "%md-sandbox", found ' || parts[1] || ': ' || line0
      WHEN 'guid_prefix' THEN 'Cmd #' || (pos + 1) || ' | Expected word[1] of the first line of MD to start with "--i18n-", found ' || guid || ': ' || line0
      WHEN 'duplicate' THEN 'Cmd #' || (pos + 1) || ' | Duplicate i18n GUID found: ' || guid
      WHEN 'no_title' THEN 'Cmd #' || (pos + 1) || ' | Missing the i18n directive, no title.'
      WHEN 'title_words' THEN 'Cmd #' || (pos + 1) || ' | Expected the title to have only one word, found ' || tw || ': ' || guid
      WHEN 'title_prefix' THEN 'Cmd #' || (pos + 1) || ' | Expected the cell title to start with "--i18n-", found ' || guid || ': ' || title END"""


@query("guid_rules", f"""
WITH r AS ({_guid_check_sql(_MD_CELLS_SQL)}),
f AS (SELECT doc_id, guid, min(pos) AS first_pos FROM r WHERE error0 IS NULL AND md GROUP BY doc_id, guid),
e AS (SELECT r.*, CASE WHEN r.md AND r.error0 IS NULL AND r.pos > f.first_pos THEN 'duplicate' ELSE r.error0 END AS error
      FROM r LEFT JOIN f ON r.doc_id = f.doc_id AND r.guid = f.guid)
SELECT doc_id, pos, guid, error, {_guid_msg_sql()} AS message FROM e""")
def guid_rules(t):
    """Rows 49, 118: i18n guid rules on markdown cells (more than one line,
    two words, %md tag, '--i18n-' prefix), then duplicates within a
    notebook: the first passing cell of a guid wins, later ones are errors
    (aggregate + join, no sort); with the reference's message texts."""
    return K.guid_findings(md_cells(t)).select("doc_id", "pos", "guid", "error", "message")


def bundles(t, translated: bool = False):
    """One translation bundle per conversation: a name line, then per turn a
    marker line ('<hr sandbox>' for system turns) and the body.  Assembled
    with an ordered collect over one conversation (bounded)."""
    c = t.conversations.select("conv_id", "turn", "role", "text")
    if translated:
        c = (c.where((col("conv_id") + col("turn")) % 10 != 0)
             .withColumn("text", F.concat(F.lit("[tr] "), col("text"))))
    guid = F.concat(col("conv_id").cast("string"), F.lit("-"),
                    F.when(col("turn") % 4 == 3, col("turn") - 2).otherwise(col("turn")).cast("string"))
    marker = F.when(col("role") == "system", F.lit("<hr sandbox>--i18n-")).otherwise(F.lit("<hr>--i18n-"))
    seg = F.concat(marker, guid, F.lit(NL), col("text"))
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", seg.alias("seg")))).alias("_s"))
    body = F.array_join(F.transform("_s", lambda s: s["seg"]), NL)
    return g.select(col("conv_id").alias("doc_id"),
                    F.concat(F.lit("## conv-"), col("conv_id").cast("string"), F.lit(NL), body).alias("bundle"))


def _bundle_sql(translated: bool) -> str:
    where = "WHERE (conv_id + turn) % 10 <> 0" if translated else ""
    text = "'[tr] ' || text" if translated else "text"
    return f"""
SELECT conv_id AS doc_id, '## conv-' || conv_id || chr(10) ||
  string_agg(CASE WHEN role = 'system' THEN '<hr sandbox>--i18n-' ELSE '<hr>--i18n-' END ||
             conv_id || '-' || CASE WHEN turn % 4 = 3 THEN turn - 2 ELSE turn END || chr(10) || {text}, chr(10) ORDER BY turn) AS bundle
FROM conversations {where} GROUP BY conv_id"""


def _bundle_map_sql(translated: bool) -> str:
    return f"""
SELECT doc_id, guid, arg_max(body, i) AS body FROM (
  SELECT doc_id, i, {strip("'--i18n-' || CASE WHEN position(chr(10) IN part) = 0 THEN part ELSE substr(part, 1, position(chr(10) IN part) - 1) END")} AS guid,
    CASE WHEN position(chr(10) IN part) = 0 THEN '' ELSE substr(part, position(chr(10) IN part) + 1) END AS body
  FROM ({_bundle_sql(translated)}) b, unnest(regexp_split_to_array(bundle, '(?m)^<hr>--i18n-|^<hr sandbox>--i18n-')) WITH ORDINALITY AS u(part, i)
  WHERE i > 1) GROUP BY doc_id, guid"""


@query("bundle_to_map", f"""
SELECT doc_id, guid, md5(body) AS body_md5, CAST(length(body) AS INTEGER) AS body_len FROM ({_bundle_map_sql(False)})""")
def bundle_to_map(t):
    """Row 119: translation bundle text -> guid map per document."""
    m = K.bundle_map(bundles(t))
    return m.select("doc_id", "guid", F.md5("body").alias("body_md5"), F.length("body").alias("body_len"))


def _merged(t):
    """markdown cells merged with the translated bundle (see ``merge_translations``)."""
    return K.merge_translations(md_cells(t), K.bundle_map(bundles(t, translated=True)))


_MERGED_SQL = f"""
WITH r AS ({_guid_check_sql(_MD_CELLS_SQL)}),
f AS (SELECT doc_id, guid, min(pos) AS first_pos FROM r WHERE error0 IS NULL AND md GROUP BY doc_id, guid),
e AS (SELECT r.*, CASE WHEN r.md AND r.error0 IS NULL AND r.pos > f.first_pos THEN 'duplicate' ELSE r.error0 END AS error
      FROM r LEFT JOIN f ON r.doc_id = f.doc_id AND r.guid = f.guid),
tr AS ({_bundle_map_sql(True)})
SELECT e.doc_id, e.pos, e.cm, e.guid, e.command,
  CASE WHEN e.error IS NOT NULL THEN 'invalid' WHEN tr.guid IS NULL THEN 'missing' ELSE 'translated' END AS status,
  CASE WHEN e.error IS NOT NULL THEN e.command
       ELSE e.cm || ' DBTITLE 0,' || e.guid || chr(10) ||
            CASE WHEN e.titled THEN '' ELSE e.cm || ' MAGIC ' || e.parts[1] || chr(10) END ||
            CASE WHEN tr.guid IS NOT NULL THEN tr.body WHEN e.titled THEN e.body ELSE {strip('e.command')} END
  END AS cell
FROM e LEFT JOIN tr ON e.doc_id = tr.doc_id AND e.guid = tr.guid"""


@query("translation_merge", f"""
SELECT doc_id, pos, guid, status, md5(cell) AS cell_md5 FROM ({_MERGED_SQL})""")
def translation_merge(t):
    """Row 21: each markdown cell's body looked up by (document, guid) in the
    translated bundle; a missing guid keeps the original (a warning)."""
    m = _merged(t)
    return m.select("doc_id", "pos", "guid", "status", F.md5("cell").alias("cell_md5"))


NOTEBOOK_HEADER = " notebook source"   # first line after the comment marker


@query("translate_documents", f"""
WITH m AS ({_MERGED_SQL}),
g AS (SELECT doc_id, min(cm) AS cm, CAST(count(*) AS BIGINT) AS n_cells,
        CAST(count_if(status = 'translated') AS BIGINT) AS n_translated,
        CAST(count_if(status = 'missing') AS BIGINT) AS n_missing, list(cell ORDER BY pos) AS cells
      FROM m GROUP BY doc_id)
SELECT doc_id, n_cells, n_translated, n_missing,
  md5(cm || '{NOTEBOOK_HEADER}' || chr(10) ||
      list_reduce(cells, lambda a, b: a || chr(10) || cm || ' COMMAND ----------' || chr(10) || b)) AS document_md5
FROM g""")
def translate_documents(t):
    """Row 120: documents rebuilt from translated cells in order (header
    line, cells joined by the command delimiter)."""
    m = _merged(t)
    g = m.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(col("status") == "translated").alias("n_translated"),
        F.count_if(col("status") == "missing").alias("n_missing"), F.min("cm").alias("cm"),
        F.sort_array(F.collect_list(F.struct("pos", "cell"))).alias("_c"))
    doc = F.concat(col("cm"), F.lit(NOTEBOOK_HEADER + NL),
                   F.call_function("array_join", F.transform("_c", lambda x: x["cell"]), K.cell_delimiter(col("cm"))))
    return g.select("doc_id", "n_cells", "n_translated", "n_missing", F.md5(doc).alias("document_md5"))


def all_cells(t):
    """Markdown cells as in :func:`md_cells`, the other turns as code cells, some titled."""
    c = cells(t).where(F.coalesce(col("role"), F.lit("")) != "assistant")
    title = F.when((col("doc_id") + col("pos")) % 6 == 0, F.concat("cm", F.lit(" DBTITLE 1,Step "), "pos", F.lit(NL))).otherwise(F.lit(""))
    code = F.concat(title, F.lit("x = "), "pos", F.lit(NL), F.coalesce(F.replace("text", F.lit(NL), F.lit(" ")), F.lit("")))
    return md_cells(t).select("doc_id", "pos", "cm", "command").union(c.select("doc_id", "pos", "cm", code))


_ALL_CELLS_SQL = f"""
SELECT doc_id, pos, cm, command FROM ({_MD_CELLS_SQL})
UNION ALL SELECT conv_id, CAST(turn AS BIGINT), cm,
  CASE WHEN (conv_id + turn) % 6 = 0 THEN cm || ' DBTITLE 1,Step ' || turn || chr(10) ELSE '' END || 'x = ' || turn || chr(10) || coalesce(replace(text, chr(10), ' '), '')
FROM (SELECT *, CASE conv_id % 4 WHEN 0 THEN '#' WHEN 1 THEN '--' WHEN 2 THEN '//' ELSE '#' END AS cm FROM conversations) WHERE coalesce(role, '') <> 'assistant'"""

_STRIPPED = strip("command")

_PUBLISHED_SQL = f"""
WITH r AS ({_guid_check_sql(_ALL_CELLS_SQL)}),
f AS (SELECT doc_id, guid, min(pos) AS first_pos FROM r WHERE error0 IS NULL AND md GROUP BY doc_id, guid),
e AS (SELECT r.*, CASE WHEN r.md AND r.error0 IS NULL AND r.pos > f.first_pos THEN 'duplicate' ELSE r.error0 END AS error
      FROM r LEFT JOIN f ON r.doc_id = f.doc_id AND r.guid = f.guid),
tr AS ({_bundle_map_sql(True)}),
x AS (
  SELECT e.*, m.mode, CASE WHEN m.mode = 'translated' THEN tr.body END AS found
  FROM e CROSS JOIN (VALUES ('translated'), ('standard'), ('plain')) m(mode) LEFT JOIN tr ON e.doc_id = tr.doc_id AND e.guid = tr.guid),
c AS (
  SELECT doc_id, mode, pos, cm, CASE
      WHEN mode = 'plain' THEN command
      WHEN NOT md THEN CASE WHEN titled THEN body ELSE command END
      WHEN error IS NOT NULL THEN command
      WHEN titled THEN cm || ' DBTITLE 0,' || guid || chr(10) || coalesce(found, body)
      ELSE cm || ' DBTITLE 0,' || guid || chr(10) || cm || ' MAGIC ' || parts[1] || chr(10) ||
        CASE WHEN mode = 'translated' THEN coalesce(found, {_STRIPPED}) ELSE substr({_STRIPPED}, position(chr(10) IN {_STRIPPED}) + 1) END END AS cell,
    CASE WHEN mode = 'plain' THEN contains(command, 'DBTITLE') OR (starts_with(command, cm || ' MAGIC %md') AND contains(command, '--i18n-'))
         ELSE md AND error IS NOT NULL END AS finding
  FROM x)"""


@query("publish_modes", _PUBLISHED_SQL + f"""
SELECT doc_id, mode, CAST(count(*) AS BIGINT) AS n_cells, CAST(count_if(finding) AS BIGINT) AS n_findings,
  md5(min(cm) || '{NOTEBOOK_HEADER}' || chr(10) || list_reduce(list(cell ORDER BY pos), lambda a, b: a || chr(10) || min(cm) || ' COMMAND ----------' || chr(10) || b)) AS document_md5
FROM c GROUP BY doc_id, mode""".replace("lambda a, b: a || chr(10) || min(cm)", "lambda a, b: a || chr(10) || cm_").replace(
    "min(cm) || '" + NOTEBOOK_HEADER, "cm_ || '" + NOTEBOOK_HEADER).replace("FROM c GROUP BY doc_id, mode", "FROM (SELECT *, cm AS cm_ FROM c) GROUP BY doc_id, mode, cm_"))
def publish_modes(t):
    """Rows 120, 121: whole documents, code cells included, published with a
    translation, without one, and with i18n switched off."""
    c, tr = all_cells(t), K.bundle_map(bundles(t, translated=True))
    out = None
    for mode in K.PUBLISH_MODES:
        d = K.joined_document(K.published_cells(c, mode, tr), NOTEBOOK_HEADER + NL).withColumn("mode", F.lit(mode))
        out = d if out is None else out.union(d)
    return out.select("doc_id", "mode", "n_cells", "n_findings", F.md5("document").alias("document_md5"))


LANGUAGE = "spanish"


@query("missing_translations", f"""
SELECT doc_id, pos, guid, 'The GUID "' || guid || '" was not found for the translation of {LANGUAGE}' AS message
FROM ({_MERGED_SQL}) WHERE status = 'missing'""")
def missing_translations(t):
    """Rows 39, 122: guids that the translated bundle lacks, with the warning's text."""
    return K.missing_translations(_merged(t), LANGUAGE)


REPLACEMENTS = {"course_name": "Course", "version": "1.2.3"}


def contents(t):
    """Cell texts with placeholders, known and unknown ones, and icons."""
    c, k = cells(t), col("doc_id") + 3 * col("pos")
    icon = F.element_at(F.array(*[F.lit(" " + i) for i in K.ICONS]), (k % 5 + 1).cast("int"))
    extra = F.concat(F.when(k % 4 == 1, " {{course_name}} {{version}}").otherwise(""), F.when(k % 9 == 2, " {{missing-key}} {{#other}}").otherwise(""),
                     F.when(k % 8 == 5, icon).otherwise(""))
    return c.select("doc_id", "pos", K.replaced(F.concat(F.coalesce("text", F.lit("")), extra), REPLACEMENTS).alias("contents"))


_CONTENTS_SQL = """
SELECT conv_id AS doc_id, CAST(turn AS BIGINT) AS pos, replace(replace(coalesce(text, '') || CASE WHEN k % 4 = 1 THEN ' {{course_name}} {{version}}' ELSE '' END
  || CASE WHEN k % 9 = 2 THEN ' {{missing-key}} {{#other}}' ELSE '' END
  || CASE WHEN k % 8 = 5 THEN ' ' || [':HINT:', ':CAUTION:', ':BESTPRACTICE:', ':SIDENOTE:', ':NOTE:'][k % 5 + 1] ELSE '' END,
  '{{course_name}}', 'Course'), '{{version}}', '1.2.3') AS contents
FROM (SELECT *, conv_id + 3 * turn AS k FROM conversations)"""


@query("left_overs", rf"""
WITH c AS ({_CONTENTS_SQL}), p AS (SELECT *, regexp_extract(contents, '\{{\{{[a-zA-Z\-\\_#/]*\}}\}}') AS what FROM c)
SELECT doc_id, pos, 'placeholder' AS kind, what, 'A mustache pattern was detected after all replacements were processed: ' || what AS message FROM p WHERE what <> ''
UNION ALL SELECT doc_id, pos, 'icon', i, 'The deprecated ' || i || ' pattern was found after all replacements were processed.'
FROM c, (VALUES (':HINT:'), (':CAUTION:'), (':BESTPRACTICE:'), (':SIDENOTE:'), (':NOTE:')) v(i) WHERE contains(contents, i)""")
def left_overs(t):
    """Rows 39, 122: placeholders and deprecated icons that are left after all replacements."""
    return K.left_overs(contents(t), "contents", ["doc_id", "pos"])


@query("invalid_paths", r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^[a-zA-Z]+://', '') AS path FROM pages)
SELECT page_id, c AS what, 'Found invalid character ' || c || ' in notebook name: ' || path AS message
FROM p, (SELECT unnest(['"', '*', '<', '>', '?', chr(92), '|', ':']) AS c) WHERE contains(path, c)""")
def invalid_paths(t):
    """Rows 39, 122: characters that a notebook's name must not hold."""
    return K.path_findings(t.pages.select("page_id", F.regexp_replace("url", "^[a-zA-Z]+://", "").alias("path")), "path", ["page_id"])


# ------------------------------------------------------------ publish outputs

_ROUTED_SQL = f"""
WITH d AS ({DIRECTIVES_SQL}),
r AS (SELECT *, CASE
        WHEN {strip('command')} = '' THEN []
        WHEN list_has_any(directives, ['SOURCE_ONLY', 'INCLUDE_HEADER_TRUE', 'INCLUDE_HEADER_FALSE', 'INCLUDE_FOOTER_TRUE', 'INCLUDE_FOOTER_FALSE']) THEN []
        WHEN list_contains(directives, 'TODO') THEN ['student']
        WHEN list_contains(directives, 'ANSWER') THEN ['solution']
        ELSE ['student', 'solution'] END AS targets FROM d)"""

HEADER_CELL = "{cm} MAGIC %md-sandbox\n{cm} MAGIC <div>course header</div>"
FOOTER_CELL = "{cm} MAGIC %md-sandbox\n{cm} MAGIC <div>course footer</div>"


def _fixed_cell_sql(template: str) -> str:
    return "replace('" + template.replace("\n", "' || chr(10) || '") + "', '{cm}', cm)"


@query("assemble_documents", _ROUTED_SQL + f""",
x AS (SELECT doc_id, pos, cm, unnest(targets) AS target, command, directives FROM r),
c AS (SELECT doc_id, pos, cm, target,
        CASE WHEN target = 'student' AND list_contains(directives, 'TODO') THEN {_clean_todo_text_sql()} ELSE command END AS cell
      FROM x),
h AS (SELECT DISTINCT d.doc_id, d.cm, t.target FROM d, (VALUES ('student'), ('solution')) t(target)
      WHERE d.doc_id IN (SELECT doc_id FROM d WHERE list_contains(directives, 'INCLUDE_HEADER_TRUE'))),
f AS (SELECT DISTINCT d.doc_id, d.cm, t.target FROM d, (VALUES ('student'), ('solution')) t(target)
      WHERE d.doc_id IN (SELECT doc_id FROM d WHERE list_contains(directives, 'INCLUDE_FOOTER_TRUE'))),
u AS (SELECT doc_id, pos, cm, target, regexp_replace(cell, '^[\\s\\p{{Z}}]+', '') AS cell FROM c
      UNION ALL SELECT doc_id, -1, cm, target, {_fixed_cell_sql(HEADER_CELL)} FROM h
      UNION ALL SELECT doc_id, 9223372036854775807, cm, target, {_fixed_cell_sql(FOOTER_CELL)} FROM f),
g AS (SELECT doc_id, target, min(cm) AS cm, CAST(count(*) AS BIGINT) AS n_cells, list(cell ORDER BY pos) AS cells FROM u GROUP BY doc_id, target)
SELECT doc_id, target, n_cells,
  md5(cm || '{NOTEBOOK_HEADER}' || chr(10) ||
      list_reduce(cells, lambda a, b: a || chr(10) || cm || ' COMMAND ----------' || chr(10) || b) ||
      CASE WHEN starts_with(cells[-1], cm || ' MAGIC') THEN '' ELSE chr(10) || chr(10) END) AS source_md5
FROM g""")
def assemble_documents(t):
    """Row 121: student and solution documents assembled per notebook:
    optional header cell first, routed cells in order (TODO cells
    uncommented for students), without white space before them, an optional
    footer cell last, joined with the command delimiter.  The
    cells of a notebook are gathered once (one bounded group per notebook)
    and both documents are built from that one array."""
    c = directive_cells(t)
    c = K.with_clean_todo(c.withColumn("targets", K.route(col("command"), col("directives"))))
    # White space before a cell goes once, before both documents are built.
    bare = lambda x: F.regexp_replace(x, rf"^{WS}+", "").alias(x)
    c = c.select("doc_id", "pos", "cm", "directives", "targets", bare("command"), bare("cleaned"))
    c = c.select("doc_id", "pos", "cm", F.struct(
        "pos", "command", "cleaned", "targets",
        F.array_contains("directives", K.D_TODO).alias("is_todo"),
        F.array_contains("directives", K.D_INCLUDE_HEADER_TRUE).alias("has_hdr"),
        F.array_contains("directives", K.D_INCLUDE_FOOTER_TRUE).alias("has_ftr")).alias("x"))
    g = c.groupBy("doc_id").agg(F.min("cm").alias("cm"), F.sort_array(F.collect_list("x")).alias("xs"))
    cm = col("cm")
    fixed = lambda flag, cell: F.when(F.exists("xs", lambda x: x[flag]), F.array(K.fill(cell, cm=cm))).otherwise(
        F.array().cast("array<string>"))

    def doc_for(target: str):
        picked = F.filter("xs", lambda x: F.array_contains(x["targets"], target))
        body = F.transform(picked, lambda x: F.when(x["is_todo"] & F.lit(target == "student"), x["cleaned"])
                           .otherwise(x["command"]))
        return F.concat(fixed("has_hdr", HEADER_CELL), body, fixed("has_ftr", FOOTER_CELL))

    docs = g.select("doc_id", "cm", F.explode(F.array(
        F.struct(F.lit("student").alias("target"), doc_for("student").alias("cells")),
        F.struct(F.lit("solution").alias("target"), doc_for("solution").alias("cells")))).alias("d"))
    docs = docs.select("doc_id", "cm", col("d.target").alias("target"), col("d.cells").alias("cells")) \
        .where(F.size("cells") > 0)
    last = F.element_at("cells", -1)
    src = F.concat(cm, F.lit(NOTEBOOK_HEADER + NL), F.call_function("array_join", col("cells"), K.cell_delimiter(cm)),
                   F.when(last.startswith(F.concat(cm, F.lit(" MAGIC"))), F.lit("")).otherwise(F.lit("\n\n")))
    return docs.select("doc_id", "target", F.size("cells").cast("bigint").alias("n_cells"), F.md5(src).alias("source_md5"))


# The gate rule messages.
GATE_MESSAGES = {
    "header": "One of the two header directives (INCLUDE_HEADER_TRUE or INCLUDE_HEADER_FALSE) were not found.",
    "footer": "One of the two footer directives (INCLUDE_FOOTER_TRUE or INCLUDE_FOOTER_FALSE) were not found.",
    "todo": "Found more TODO commands (%d) than ANSWER commands (%d)",
}


@query("doc_gate_rules", _ROUTED_SQL + """,
s AS (SELECT doc_id,
        CAST(count_if(list_contains(targets, 'student') AND NOT list_contains(targets, 'solution') AND list_contains(directives, 'TODO')) AS BIGINT) AS todo_count,
        CAST(count_if(list_contains(targets, 'solution') AND NOT list_contains(targets, 'student') AND list_contains(directives, 'ANSWER')) AS BIGINT) AS answer_count,
        bool_or(list_has_any(directives, ['INCLUDE_HEADER_TRUE', 'INCLUDE_HEADER_FALSE'])) AS found_header,
        bool_or(list_has_any(directives, ['INCLUDE_FOOTER_TRUE', 'INCLUDE_FOOTER_FALSE'])) AS found_footer,
        bool_or(list_contains(directives, 'INCLUDE_HEADER_TRUE')) AS include_header
      FROM r GROUP BY doc_id)
SELECT *, concat_ws(',', CASE WHEN NOT found_header THEN 'missing_header_directive' END,
                         CASE WHEN NOT found_footer THEN 'missing_footer_directive' END,
                         CASE WHEN answer_count < todo_count THEN 'more_todo_than_answer' END) AS errors,
  concat_ws(chr(10),
    CASE WHEN NOT found_header THEN 'One of the two header directives (INCLUDE_HEADER_TRUE or INCLUDE_HEADER_FALSE) were not found.' END,
    CASE WHEN NOT found_footer THEN 'One of the two footer directives (INCLUDE_FOOTER_TRUE or INCLUDE_FOOTER_FALSE) were not found.' END,
    CASE WHEN answer_count < todo_count THEN 'Found more TODO commands (' || todo_count || ') than ANSWER commands (' || answer_count || ')' END) AS messages
FROM s""")
def doc_gate_rules(t):
    """Row 52: per notebook the TODO / ANSWER counts, header and footer
    directive flags, and the gate rules over them."""
    c = directive_cells(t)
    c = c.withColumn("targets", K.route(col("command"), col("directives")))
    tg = col("targets")
    dirs = col("directives")
    has = lambda d: F.array_contains(dirs, d)
    student_only = F.array_contains(tg, "student") & ~F.array_contains(tg, "solution")
    solution_only = F.array_contains(tg, "solution") & ~F.array_contains(tg, "student")
    s = c.groupBy("doc_id").agg(
        F.count_if(student_only & has(K.D_TODO)).alias("todo_count"),
        F.count_if(solution_only & has(K.D_ANSWER)).alias("answer_count"),
        F.bool_or(has(K.D_INCLUDE_HEADER_TRUE) | has(K.D_INCLUDE_HEADER_FALSE)).alias("found_header"),
        F.bool_or(has(K.D_INCLUDE_FOOTER_TRUE) | has(K.D_INCLUDE_FOOTER_FALSE)).alias("found_footer"),
        F.bool_or(has(K.D_INCLUDE_HEADER_TRUE)).alias("include_header"))
    errors = F.concat_ws(",", F.when(~col("found_header"), F.lit("missing_header_directive")),
                         F.when(~col("found_footer"), F.lit("missing_footer_directive")),
                         F.when(col("answer_count") < col("todo_count"), F.lit("more_todo_than_answer")))
    messages = F.concat_ws("\n", *[F.when(c, F.lit(m)) for c, m in [
        (~col("found_header"), GATE_MESSAGES["header"]), (~col("found_footer"), GATE_MESSAGES["footer"])]],
        F.when(col("answer_count") < col("todo_count"),
               F.format_string(GATE_MESSAGES["todo"], col("todo_count"), col("answer_count"))))
    return s.withColumn("errors", errors).withColumn("messages", messages)


@query("resource_bundle", f"""
WITH m AS ({_MERGED_SQL}),
b AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'sql' WHEN 2 THEN 'scala' ELSE 'r' END AS language,
        CAST(count(*) AS BIGINT) AS n_cells,
        string_agg(replace(replace(replace(command, cm || ' MAGIC ', ''), '%md-sandbox --i18n-', '<hr sandbox>--i18n-'),
                           '%md --i18n-', '<hr>--i18n-') || chr(10), '' ORDER BY pos) AS bundle
      FROM m WHERE status <> 'invalid' GROUP BY doc_id)
SELECT doc_id, language, n_cells, md5('# /conv-' || doc_id || chr(10) || bundle) AS bundle_md5 FROM b""")
def resource_bundle(t):
    """Row 10: the markdown cells of each notebook (with a valid guid) as one
    translation bundle, ordered by position: a path line, then the cells
    without their magic prefix, the guid line as a marker; see
    ``sinks.write_bundles``."""
    return bundle_frame(t).select("doc_id", "language", "n_cells", F.md5("bundle").alias("bundle_md5"))


def bundle_frame(t):
    m = _merged(t).where(col("status") != "invalid")
    cell = F.replace(col("command"), F.concat(col("cm"), F.lit(" MAGIC ")), F.lit(""))
    cell = F.replace(cell, F.lit("%md-sandbox --i18n-"), F.lit("<hr sandbox>--i18n-"))
    cell = F.concat(F.replace(cell, F.lit("%md --i18n-"), F.lit("<hr>--i18n-")), F.lit(NL))
    g = m.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_cells"), F.sort_array(F.collect_list(F.struct("pos", cell.alias("cell")))).alias("_s"))
    language = F.element_at(F.array(*[F.lit(x) for x in ("python", "sql", "scala", "r")]), (col("doc_id") % 4 + 1).cast("int"))
    bundle = F.concat(F.lit("# /conv-"), col("doc_id").cast("string"), F.lit(NL), F.array_join(F.transform("_s", lambda x: x["cell"]), ""))
    return g.select("doc_id", language.alias("language"), "n_cells", bundle.alias("bundle"))


# ------------------------------------------------------------ duplicates, logs

@query("duplicate_keys", """
WITH d AS (SELECT doc_id, source, sha256(text) AS h FROM documents),
f AS (SELECT source, h, min(doc_id) AS first_doc_id FROM d GROUP BY source, h)
SELECT d.source, d.doc_id, f.first_doc_id FROM d JOIN f ON d.source = f.source AND d.h = f.h WHERE d.doc_id > f.first_doc_id""")
def duplicate_keys(t):
    """Row 49: within a source, the second and later documents with the
    same text (by digest); the first by id is kept.  Aggregate + join, so
    a hot key is partially aggregated instead of sorted in one task."""
    d = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("h"))
    first = d.groupBy("source", "h").agg(F.min("doc_id").alias("first_doc_id"))
    return d.join(first, ["source", "h"]).where(col("doc_id") > col("first_doc_id")).select(
        "source", "doc_id", "first_doc_id")




def readme_lines(t):
    """documents as READMEs: a title, the change-log tag, then a version
    header every fourth line and the document lines as bullet entries."""
    d = t.documents.select("doc_id", "source", F.split("text", NL, -1).alias("lines"))

    def mk(line, i):
        date = F.when(i % 3 == 0, F.lit("TBD")).otherwise(
            F.concat((i % 12 + 1).cast("string"), F.lit("-"), (i % 28 + 1).cast("string"), F.lit("-2024")))
        # (a version with a letter in it, in the second header of some)
        minor = F.when((col("doc_id") % 7 == 0) & (i == 6), F.lit("x")).otherwise(i.cast("string"))
        hdr = F.concat(F.lit(K.CHANGE_LOG_VERSION), (col("doc_id") % 10).cast("string"), F.lit("."), minor,
                       F.lit(".0 ("), date, F.lit(")"))
        return (F.when(i == 0, F.concat(F.lit("# "), col("source"))).when(i == 1, F.lit(K.CHANGE_LOG_TAG))
                .when((i - 2) % 4 == 0, hdr).otherwise(F.concat(F.lit("* "), line)))
    return d.select("doc_id", F.transform("lines", mk).alias("readme"))


def wanted_version():
    """Any, the second or an unknown version, by document."""
    k = col("doc_id") % 3
    return F.when(k == 1, F.concat((col("doc_id") % 10).cast("string"), F.lit(".6.0"))).when(k == 2, "0.0.0")


@query("changelog_entries", f"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines,
        CASE doc_id % 3 WHEN 1 THEN CAST(doc_id % 10 AS VARCHAR) || '.6.0' WHEN 2 THEN '0.0.0' END AS wanted FROM documents),
r AS (SELECT doc_id, wanted, list_transform(lines, lambda line, j: CASE
        WHEN j - 1 = 0 THEN '# ' || source WHEN j - 1 = 1 THEN '{K.CHANGE_LOG_TAG}'
        WHEN (j - 3) % 4 = 0 THEN '{K.CHANGE_LOG_VERSION}' || CAST(doc_id % 10 AS VARCHAR) || '.' ||
             CASE WHEN doc_id % 7 = 0 AND j = 7 THEN 'x' ELSE CAST(j - 1 AS VARCHAR) END || '.0 (' ||
             CASE WHEN (j - 1) % 3 = 0 THEN 'TBD' ELSE CAST((j - 1) % 12 + 1 AS VARCHAR) || '-' || CAST((j - 1) % 28 + 1 AS VARCHAR) || '-2024' END || ')'
        ELSE '* ' || line END) AS readme FROM d),
s AS (SELECT doc_id, wanted, list_transform(readme, lambda l: {strip('l')}) AS ls FROM r),
l AS (SELECT doc_id, wanted, ls, u.line, u.i FROM s, unnest(ls) WITH ORDINALITY AS u(line, i)),
tag AS (SELECT doc_id, min(i) AS tag FROM l WHERE line = '{K.CHANGE_LOG_TAG}' GROUP BY doc_id),
h AS (SELECT l.*, string_split(line, ' ') AS parts, string_split(string_split(line, ' ')[3], '.') AS nums
      FROM l JOIN tag USING (doc_id) WHERE i > tag AND tag > 1 AND line <> '' AND NOT starts_with(line, '* ')),
c AS (SELECT *, CASE WHEN NOT starts_with(line, '{K.CHANGE_LOG_VERSION}') THEN 'no_version' WHEN len(parts) <> 4 THEN 'parts'
        WHEN len(nums) <> 3 OR NOT regexp_matches(parts[3], '^[0-9]+\\.[0-9]+\\.[0-9]+$') THEN 'version' END AS error FROM h),
w AS (SELECT doc_id, min(i) FILTER (WHERE error IS NULL AND (wanted IS NULL OR wanted = parts[3])) AS vi, min(i) FILTER (WHERE error IS NOT NULL) AS ei,
        arg_min(error, i) FILTER (WHERE error IS NOT NULL) AS error FROM c GROUP BY doc_id),
f AS (SELECT s.doc_id, wanted, ls, CASE WHEN ei < coalesce(vi, ei + 1) THEN error WHEN vi IS NULL THEN 'not_found' END AS error, vi FROM s LEFT JOIN w USING (doc_id)),
n AS (SELECT *, CASE WHEN error IS NULL THEN vi END AS v_at FROM f),
m AS (SELECT *, coalesce(list_filter(range(1, len(ls) + 1), lambda i: i > v_at AND starts_with(ls[i], '#'))[1], len(ls) + 1) AS nx FROM n),
e AS (SELECT *, string_split(ls[v_at], ' ') AS p, CASE WHEN v_at IS NULL THEN [] ELSE list_filter(ls[v_at + 1:nx - 1], lambda l: l <> '') END AS entries FROM m)
SELECT doc_id, wanted, p[3] AS version, substr(p[4], 2, length(p[4]) - 2) AS date,
  CASE WHEN error IS NOT NULL THEN error WHEN p[4] <> '(TBD)' AND NOT regexp_matches(p[4], '^\\([0-9]+-[0-9]+-[0-9]+\\)$') THEN 'date'
       WHEN len(entries) = 0 THEN 'no_entries' END AS error,
  CAST(len(entries) AS INTEGER) AS n_entries, md5(array_to_string(entries, chr(10))) AS entries_md5
FROM e""")
def changelog_entries(t):
    """Rows 50, 77: the change-log state machine per README, inside each row:
    the tag, the headers after it up to the wanted version (the first one if
    none is wanted), and the entries up to the next heading; a malformed
    header on the way, an unknown version or a bad date (M-D-YYYY or TBD) is
    reported."""
    r = readme_lines(t).withColumn("wanted", wanted_version())
    return K.change_log(r, "readme", "wanted").select(
        "doc_id", "wanted", "version", "date", "error", F.size("entries").alias("n_entries"), F.md5(F.array_join("entries", NL)).alias("entries_md5"))


# ------------------------------------------------------------ segment files

def segment_files(t, latest: bool = False):
    """One segment file per conversation: the file name on line 0, then per
    turn a marker line and the body.  The latest side drops files with
    conv_id % 25 = 0 and turns with (conv_id + turn) % 10 = 0, and revises
    turns with (conv_id + turn) % 9 = 0."""
    c = t.conversations.select("conv_id", "turn", "role", "text")
    if latest:
        k = col("conv_id") + col("turn")
        c = (c.where((col("conv_id") % 25 != 0) & (k % 10 != 0))
             .withColumn("text", F.when(k % 9 == 0, F.concat(col("text"), F.lit(" (rev)"))).otherwise(col("text"))))
    marker = F.when(col("role") == "system", F.lit("<hr sandbox>--i18n-")).otherwise(F.lit("<hr>--i18n-"))
    seg = F.concat(marker, col("conv_id").cast("string"), F.lit("-"), col("turn").cast("string"), F.lit(NL), col("text"))
    g = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", seg.alias("seg")))).alias("_s"))
    name = F.concat(F.lit("conv-"), col("conv_id").cast("string"), F.lit(".md"))
    return g.select(name.alias("file"), F.concat(name, F.lit(NL), F.array_join(F.transform("_s", lambda x: x["seg"]), NL))
                    .alias("text"))


def _segment_files_sql(latest: bool) -> str:
    where = "WHERE conv_id % 25 <> 0 AND (conv_id + turn) % 10 <> 0" if latest else ""
    text = "CASE WHEN (conv_id + turn) % 9 = 0 THEN text || ' (rev)' ELSE text END" if latest else "text"
    return f"""
SELECT 'conv-' || conv_id || '.md' AS file, 'conv-' || conv_id || '.md' || chr(10) ||
  string_agg(CASE WHEN role = 'system' THEN '<hr sandbox>--i18n-' ELSE '<hr>--i18n-' END || conv_id || '-' || turn || chr(10) || {text},
             chr(10) ORDER BY turn) AS text
FROM conversations {where} GROUP BY conv_id"""


def _segments_sql(latest: bool) -> str:
    return f"""
SELECT file, guid, arg_max(contents, m) AS contents FROM (
  SELECT file, m, {strip("CASE WHEN starts_with(lines[m], '<hr>--i18n-') THEN substr(lines[m], 12) ELSE substr(lines[m], 20) END")} AS guid,
    array_to_string(lines[m + 1:nx - 1], chr(10)) AS contents
  FROM (
    SELECT file, lines, unnest(marks) AS m, unnest(nexts) AS nx FROM (
      SELECT file, lines, marks, list_transform(marks, lambda m, k: coalesce(marks[k + 1], len(lines) + 1)) AS nexts FROM (
        SELECT file, lines, list_filter(range(2, len(lines) + 1),
               lambda i: starts_with(lines[i], '<hr>--i18n-') OR starts_with(lines[i], '<hr sandbox>--i18n-')) AS marks
        FROM (SELECT file, string_split(text, chr(10)) AS lines FROM ({_segment_files_sql(latest)}))))))
GROUP BY file, guid"""


@query("segment_lines", f"""
SELECT file, guid, CAST(len(string_split(contents, chr(10))) AS INTEGER) AS n_lines, md5({strip('contents')}) AS contents_md5
FROM ({_segments_sql(False)})""")
def segment_lines(t):
    """Row 51: segment files parsed into guid -> contents."""
    s = K.read_segments(segment_files(t))
    return s.select("file", "guid", F.size(F.split("contents", NL, -1)).alias("n_lines"),
                    F.md5(py_strip(col("contents"))).alias("contents_md5"))


@query("segment_diff", f"""
WITH fa AS ({_segment_files_sql(False)}), fb AS ({_segment_files_sql(True)}),
a AS ({_segments_sql(False)}), b AS ({_segments_sql(True)}),
both_files AS (SELECT fa.file FROM fa JOIN fb ON fa.file = fb.file)
SELECT fa.file, 'Missing Notebook' AS change_type, fa.file || ' from latest' AS message FROM fa WHERE fa.file NOT IN (SELECT file FROM fb)
UNION ALL SELECT fb.file, 'Missing Notebook', fb.file || ' from original' FROM fb WHERE fb.file NOT IN (SELECT file FROM fa)
UNION ALL
SELECT coalesce(a.file, b.file), CASE WHEN a.guid IS NULL THEN 'Cell Added' WHEN b.guid IS NULL THEN 'Cell Removed' ELSE 'Cell Changed' END,
  coalesce(a.guid, b.guid)
FROM (SELECT * FROM a WHERE file IN (SELECT file FROM both_files)) a
FULL OUTER JOIN (SELECT * FROM b WHERE file IN (SELECT file FROM both_files)) b ON a.file = b.file AND a.guid = b.guid
WHERE a.guid IS NULL OR b.guid IS NULL OR {strip('a.contents')} <> {strip('b.contents')}""")
def segment_diff(t):
    """Rows 60, 105: original vs latest segment files: Missing Notebook per file
    (the union of both file lists), else Cell Added / Removed / Changed per
    guid (whitespace-stripped compare); each side is read once and joined
    once on (file, guid) with a per-file marker row."""
    return K.segment_diff(segment_files(t), segment_files(t, latest=True))


# ------------------------------------------------------------ links and lint

LINK_FORMS = (".", "..", "../..", "")      # by page: what stands before the link's own path


@query("dangling_links", f"""
WITH p AS (SELECT page_id, regexp_replace(substr(path, 2), '/+$', '') AS path FROM ({S.PAGE_PATHS_SQL})),
l AS (SELECT page_id, CAST(u.i - 1 AS INTEGER) AS link_no,
        CASE page_id % 4 {" ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LINK_FORMS))} END || regexp_extract(u.link, 'href="([^"]*)"', 1) AS href
      FROM pages, unnest(regexp_extract_all(html, '<a .*?</a>')) WITH ORDINALITY AS u(link, i)),
r AS (SELECT l.*, page_id % 4 <> 3 AS relative, CASE WHEN page_id % 4 <> 3 THEN {_resolve_sql('path', 'href')} END AS target FROM l JOIN p USING (page_id))
SELECT page_id, link_no, href, target, CASE WHEN relative THEN 'error' ELSE 'warning' END AS severity,
  CASE WHEN relative THEN 'Cmd #1 | Cannot find notebook for the link target: "' || href || '" resolved as "' || target || '"'
       ELSE 'Cmd #1 | Found unexpected, relative, link target: "' || href || '" resolved as "' || href || '"' END AS message
FROM r LEFT JOIN ({_KNOWN_PAGES_SQL}) k ON k.known = r.target WHERE NOT relative OR k.known IS NULL""")
def dangling_links(t):
    """Row 30: links resolved from the folder of their page (``./``, and one
    folder up for each ``../``) that are neither a page nor a folder of pages;
    other links are a warning."""
    lead = F.element_at(F.array(*[F.lit(x) for x in LINK_FORMS]), (col("page_id") % 4 + 1).cast("int"))
    links = t.pages.select("page_id", F.posexplode(K.html_links(col("html"))).alias("link_no", "link"))
    links = links.select("page_id", "link_no", F.concat(lead, F.regexp_extract("link", 'href="([^"]*)"', 1)).alias("href"), F.lit(0).alias("pos"))
    found = K.check_targets(links.join(page_notebooks(t), "page_id"), page_notebooks(t), "link", original="href", target="href")
    return found.where(col("severity").isNotNull()).select("page_id", "link_no", "href", col("resolved").alias("target"), "severity", "message")


from assay.plans.registry import ORACLES  # noqa: E402


IGNORE_RULES = {"html_link": "page_id % 4 = 0", "directive": "conv_id % 5 = 0"}


def _per_doc_findings(t):
    """(doc_key, n_errors, n_warnings) after the ignore list, computed with
    one pass per source: notebook cells are evaluated once and all their
    findings (directives, TODO checks, gate rules) summed in one grouping."""
    c = directive_cells(t)
    c = K.with_clean_todo(c.withColumn("targets", K.route(col("command"), col("directives"))))
    dirs = col("directives")
    has = lambda d: F.array_contains(dirs, d)
    tg = col("targets")
    student_only = F.array_contains(tg, "student") & ~F.array_contains(tg, "solution")
    solution_only = F.array_contains(tg, "solution") & ~F.array_contains(tg, "student")
    cell = c.groupBy("doc_id").agg(
        F.sum("errors").alias("dir_err"), F.sum("warnings").alias("dir_warn"),
        F.sum(F.when(has(K.D_TODO), col("todo_errors")).otherwise(0)).alias("todo_err"),
        F.count_if(student_only & has(K.D_TODO)).alias("todo_count"),
        F.count_if(solution_only & has(K.D_ANSWER)).alias("answer_count"),
        F.bool_or(has(K.D_INCLUDE_HEADER_TRUE) | has(K.D_INCLUDE_HEADER_FALSE)).alias("found_header"),
        F.bool_or(has(K.D_INCLUDE_FOOTER_TRUE) | has(K.D_INCLUDE_FOOTER_FALSE)).alias("found_footer"))
    gate = (F.when(~col("found_header"), 1).otherwise(0) + F.when(~col("found_footer"), 1).otherwise(0)
            + F.when(col("answer_count") < col("todo_count"), 1).otherwise(0))
    ignored = col("doc_id") % 5 == 0
    cell = cell.select("doc_id",
                       (F.when(ignored, 0).otherwise(col("dir_err")) + col("todo_err") + gate).alias("e1"),
                       F.when(ignored, 0).otherwise(col("dir_warn")).alias("w1"))
    gr = guid_rules(t).where(col("error").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("e2"))
    left = left_overs(t).select("doc_id", F.lit("error").alias("severity"))
    lost = missing_translations(t).select("doc_id", F.lit("warning").alias("severity"))
    rt = run_targets(t).select("doc_id", "severity").unionByName(
        magic_lint(t).select("doc_id", F.lit("warning").alias("severity"))).unionByName(left).unionByName(lost).groupBy("doc_id").agg(
        F.count_if(col("severity") == "error").alias("e3"), F.count_if(col("severity") == "warning").alias("w3"))
    conv = (cell.join(gr, "doc_id", "full_outer").join(rt, "doc_id", "full_outer")
            .select(F.concat(F.lit("conv-"), col("doc_id").cast("string")).alias("doc_key"),
                    (F.coalesce("e1", F.lit(0)) + F.coalesce("e2", F.lit(0)) + F.coalesce("e3", F.lit(0))).alias("n_errors"),
                    (F.coalesce("w1", F.lit(0)) + F.coalesce("w3", F.lit(0))).alias("n_warnings")))
    pages = (html_link_lint(t).where(col("missing_target") & (col("page_id") % 4 != 0)).select("page_id", F.lit("warning").alias("severity"))
             .unionByName(md_link_lint(t).where("severity is not null").select("page_id", "severity"))
             .unionByName(invalid_paths(t).select("page_id", F.lit("warning").alias("severity"))).groupBy("page_id")
             .agg(F.count_if(col("severity") == "error").alias("n_errors"), F.count_if(col("severity") == "warning").alias("n_warnings"))
             .select(F.concat(F.lit("page-"), col("page_id").cast("string")).alias("doc_key"), "n_errors", "n_warnings"))
    # documents: token errors and prohibited-literal warnings in one pass over the text
    d = t.documents.select("doc_id", "lang", "text")
    n_err = F.size(token_hits(col("text"))).cast("bigint")
    n_warn = F.when(col("lang").isin(SOURCE_LANGS),
                    F.size(F.filter(prohibited_hits(col("text")), lambda h: h["line"].isNotNull()))).otherwise(0)
    counts = d.select(F.concat(F.lit("doc-"), col("doc_id").cast("string")).alias("doc_key"),
                      F.struct(n_err.alias("n_errors"), n_warn.cast("bigint").alias("n_warnings")).alias("c"))
    keep = F.when((col("c.n_errors") + col("c.n_warnings")) > 0, F.array("c")).otherwise(
        F.array().cast("array<struct<n_errors:bigint,n_warnings:bigint>>"))
    docs = counts.select("doc_key", F.inline(keep))
    out = conv.unionByName(pages).unionByName(docs)
    return (out.select("doc_key", col("n_errors").cast("bigint").alias("n_errors"),
                       col("n_warnings").cast("bigint").alias("n_warnings"))
            .where((col("n_errors") + col("n_warnings")) > 0))


_FINDINGS_SQL = f"""
WITH ed AS ({ORACLES['extract_directives']}), ut AS ({ORACLES['uncomment_todo']}), gr AS ({ORACLES['guid_rules']}),
rt AS ({ORACLES['run_targets']}), gt AS ({ORACLES['doc_gate_rules']}), hl AS ({ORACLES['html_link_lint']}),
ml AS ({ORACLES['magic_lint']}), md AS ({ORACLES['md_link_lint']}),
lo AS ({ORACLES['left_overs']}), mt AS ({ORACLES['missing_translations']}), ip AS ({ORACLES['invalid_paths']}),
ft AS ({ORACLES['forbidden_tokens']}), pl AS ({ORACLES['prohibited_lines']}),
fnd AS (
  SELECT 'conv-' || doc_id AS doc_key, 'directive' AS kind, 'error' AS severity, CAST(errors AS BIGINT) AS n FROM ed WHERE errors > 0
  UNION ALL SELECT 'conv-' || doc_id, 'directive', 'warning', warnings FROM ed WHERE warnings > 0
  UNION ALL SELECT 'conv-' || doc_id, 'todo', 'error', errors FROM ut WHERE errors > 0
  UNION ALL SELECT 'conv-' || doc_id, 'i18n', 'error', 1 FROM gr WHERE error IS NOT NULL
  UNION ALL SELECT 'conv-' || doc_id, kind, severity, 1 FROM rt WHERE severity IS NOT NULL
  UNION ALL SELECT 'conv-' || doc_id, 'magic', 'warning', 1 FROM ml
  UNION ALL SELECT 'page-' || page_id, 'md_link', severity, 1 FROM md WHERE severity IS NOT NULL
  UNION ALL SELECT 'conv-' || doc_id, 'gate', 'error', len(string_split(errors, ',')) FROM gt WHERE errors <> ''
  UNION ALL SELECT 'page-' || page_id, 'html_link', 'warning', 1 FROM hl WHERE missing_target
  UNION ALL SELECT 'conv-' || doc_id, kind, 'error', 1 FROM lo
  UNION ALL SELECT 'conv-' || doc_id, 'translation', 'warning', 1 FROM mt
  UNION ALL SELECT 'page-' || page_id, 'path', 'warning', 1 FROM ip
  UNION ALL SELECT 'doc-' || doc_id, 'token', 'error', 1 FROM ft
  UNION ALL SELECT 'doc-' || doc_id, 'source', 'warning', 1 FROM pl),
ign AS (SELECT 'page-' || page_id AS doc_key, 'html_link' AS kind FROM pages WHERE page_id % 4 = 0
        UNION ALL SELECT DISTINCT 'conv-' || conv_id, 'directive' FROM conversations WHERE conv_id % 5 = 0),
kept AS (SELECT * FROM fnd WHERE (doc_key, kind) NOT IN (SELECT (doc_key, kind) FROM ign)),
per AS (SELECT doc_key, CAST(coalesce(sum(n) FILTER (WHERE severity = 'error'), 0) AS BIGINT) AS n_errors,
          CAST(coalesce(sum(n) FILTER (WHERE severity = 'warning'), 0) AS BIGINT) AS n_warnings FROM kept GROUP BY doc_key)"""


@query("lint_findings", _FINDINGS_SQL + """
SELECT doc_key, n_errors, n_warnings, n_errors > 0 AS abort FROM per""")
def lint_findings(t):
    """Row 122: every finding (errors and warnings) per document, minus the
    document's ignore list, with the abort verdict."""
    return _per_doc_findings(t).withColumn("abort", col("n_errors") > 0)


@query("lint_summary", _FINDINGS_SQL + """
SELECT doc_key, n_errors, n_warnings FROM per
UNION ALL SELECT '(total)', CAST(sum(n_errors) AS BIGINT), CAST(sum(n_warnings) AS BIGINT) FROM per""")
def lint_summary(t):
    """Row 39: errors and warnings per document plus one total row (the
    reference adds the totals twice; the totals here are counted once)."""
    per = _per_doc_findings(t)
    # rollup adds the grand total to the per-document rows in the same pass
    r = per.rollup("doc_key").agg(F.sum("n_errors").cast("bigint").alias("n_errors"),
                                  F.sum("n_warnings").cast("bigint").alias("n_warnings"))
    return r.select(F.coalesce("doc_key", F.lit("(total)")).alias("doc_key"), "n_errors", "n_warnings")
