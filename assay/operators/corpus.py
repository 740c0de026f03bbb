"""Column builders for corpus jobs: cells, leading comments, directives,
TODO uncommenting, first-hit lines, link extraction.

All of them work inside one row (higher-order functions over the lines of a
cell or a document), so a whole document never leaves its row and nothing
is collected across rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from assay.functions.text import py_strip, tail

# Directive names, the SQL words that look like directives,
# and the header/footer directives that do not count as a cell's directive.
D_TODO, D_ANSWER, D_SOURCE_ONLY, D_DUMMY = "TODO", "ANSWER", "SOURCE_ONLY", "DUMMY"
D_TROUBLESHOOTING_CONTENT, D_INSTALL_LIBRARIES = "TROUBLESHOOTING_CONTENT", "INSTALL_LIBRARIES"
D_INCLUDE_HEADER_TRUE, D_INCLUDE_HEADER_FALSE = "INCLUDE_HEADER_TRUE", "INCLUDE_HEADER_FALSE"
D_INCLUDE_FOOTER_TRUE, D_INCLUDE_FOOTER_FALSE = "INCLUDE_FOOTER_TRUE", "INCLUDE_FOOTER_FALSE"
SUPPORTED_DIRECTIVES = [D_SOURCE_ONLY, D_ANSWER, D_TODO, D_DUMMY, D_TROUBLESHOOTING_CONTENT, D_INSTALL_LIBRARIES,
                        D_INCLUDE_HEADER_TRUE, D_INCLUDE_HEADER_FALSE, D_INCLUDE_FOOTER_TRUE, D_INCLUDE_FOOTER_FALSE]
ACCEPTED_DIRECTIVES = [D_TODO, D_ANSWER, D_SOURCE_ONLY, D_INCLUDE_HEADER_TRUE, D_INCLUDE_HEADER_FALSE,
                       D_INCLUDE_FOOTER_TRUE, D_INCLUDE_FOOTER_FALSE]
HEADER_FOOTER = [D_INCLUDE_HEADER_TRUE, D_INCLUDE_HEADER_FALSE, D_INCLUDE_FOOTER_TRUE, D_INCLUDE_FOOTER_FALSE]
SQL_WORDS = ["SELECT", "FROM", "AS", "AND"]

# Comment marker per notebook language.
COMMENT_MARKERS = {"python": "#", "sql": "--", "md": "--", "r": "#", "scala": "//"}


def comment_marker(language: Column) -> Column:
    """Marker by language; as in the reference a language is matched as a
    *substring* of the known name, so '' (and 'py') resolve to python."""
    lang = F.lower(F.replace(language, F.lit("%"), F.lit("")))
    known = F.lit("python")
    return (F.when(known.contains(lang), "#").when(F.lit("sql").contains(lang), "--")
            .when(F.lit("md").contains(lang), "--").when(F.lit("r").contains(lang), "#")
            .when(F.lit("scala").contains(lang), "//"))


def cell_delimiter(cm: Column) -> Column:
    return F.concat(F.lit("\n"), cm, F.lit(" COMMAND ----------\n"))


# Directive message texts (the publishing-help pointer neutral).
DIRECTIVE_MESSAGES = {
    "double_todo": "Found double-comment of TODO directive",
    "hyphen": "Hyphen found in directive ",
    "unsupported": "Unsupported directive ",
    "see": ", see the publishing help for more information.",
    "multiple": "Found multiple directives (",
}


def with_leading_comments(df: DataFrame, command: str = "command", cm: str = "cm",
                          out: str = "comments") -> DataFrame:
    """Add ``out``: the comment texts before the first non-comment line.

    Staged as successive projections over the line array so every
    intermediate is computed once (no expression is copied into its users)."""
    c, n = F.col(cm), F.length(F.col(cm))
    lines = F.split(py_strip(F.col(command)), "\n", -1)
    # the comment marker inside the cell follows its magic (%md, %sql, ...)
    first = F.lower(lines[0])
    magic = lambda m: first.startswith(F.concat(c, F.lit(f" magic {m}")))
    df = df.withColumn("_cm", F.when(magic("%md"), F.lit(COMMENT_MARKERS["md"]))
                       .when(magic("%sql"), F.lit(COMMENT_MARKERS["sql"]))
                       .when(magic("%python"), F.lit(COMMENT_MARKERS["python"]))
                       .when(magic("%scala"), F.lit(COMMENT_MARKERS["scala"]))
                       .when(magic("%run"), c)
                       .when(magic("%r"), F.lit(COMMENT_MARKERS["r"]))
                       .otherwise(c))
    cell_m, cn = F.col("_cm"), F.length(F.col("_cm"))
    df = df.withColumn("_lc1", F.transform(lines, lambda l: (
        F.when(l.startswith(F.concat(c, F.lit(" MAGIC"))), py_strip(tail(l, n + 7)))
         .when(l.startswith(F.concat(c, F.lit(" COMMAND"))), py_strip(tail(l, n + 9)))
         .otherwise(l))))
    df = df.withColumn("_lc2", F.transform("_lc1", lambda l: F.struct(
        l.alias("l1"), py_strip(l).alias("s1"), F.instr(l, " ").alias("sp"))))
    df = df.withColumn("_lc3", F.transform("_lc2", lambda x: py_strip(
        F.when(x["s1"].startswith("%"), F.when(x["sp"] == 0, F.lit(""))
               .otherwise(py_strip(tail(x["l1"], x["sp"])))).otherwise(x["l1"]))))
    df = df.withColumn("_lc4", F.transform("_lc3", lambda s: F.struct(
        F.when((s == cell_m) | (s == ""), "skip").when(s.startswith(cell_m), "comment").otherwise("stop").alias("kind"),
        py_strip(tail(s, cn + 1)).alias("text"))))
    df = df.withColumn("_lcstop", F.array_position(F.transform("_lc4", lambda k: k["kind"] == "stop"), True))
    take = F.when(F.col("_lcstop") == 0, F.col("_lc4")).otherwise(
        F.slice("_lc4", F.lit(1), (F.col("_lcstop") - 1).cast("int")))
    df = df.withColumn(out, F.transform(F.filter(take, lambda k: k["kind"] == "comment"), lambda k: k["text"]))
    return df.drop("_cm", "_lc1", "_lc2", "_lc3", "_lc4", "_lcstop")


def with_directives(df: DataFrame, comments: str = "comments") -> DataFrame:
    """Add ``directives`` (array), ``n_main``, ``errors`` and ``warnings``.

    A comment is a directive when it is upper case and a known name, or a
    clean name (only letters, '-' and '_') without warnings; a doubled
    comment marker in front of TODO is an error; hyphens and unsupported
    names are warnings."""
    df = df.withColumn("_dc1", F.transform(comments, lambda c: F.struct(
        c.alias("text"), py_strip(c).alias("d"), (c != F.upper(c)).alias("lower"))))
    df = df.withColumn("_dc2", F.transform("_dc1", lambda x: F.struct(
        x["text"].alias("text"), x["d"].alias("d"), x["lower"].alias("lower"),
        F.regexp_replace(x["d"], "[^-a-zA-Z_]", "_").alias("mod"),
        (F.when(x["d"].contains("-"), 1).otherwise(0)
         + F.when(~x["d"].isin(SUPPORTED_DIRECTIVES), 1).otherwise(0)).alias("warn"))))
    df = df.withColumn("_dc3", F.transform("_dc2", lambda x: F.struct(
        x["text"].alias("text"),
        F.when(x["lower"], "none").when(x["d"].isin(SQL_WORDS), "none")
         .when(x["d"].isin(ACCEPTED_DIRECTIVES), "directive")
         .when(x["d"].contains("FILL-IN") | x["d"].contains("FILL_IN"), "none")
         .when(x["d"] != x["mod"], F.when(x["mod"].isin("__" + D_TODO, "___" + D_TODO), "double_todo")
               .otherwise("none"))
         .when(x["warn"] > 0, "warned").otherwise("directive").alias("cls"),
        x["warn"].alias("warn"), x["d"].alias("d"))))
    df = df.withColumn("directives", F.transform(F.filter("_dc3", lambda x: x["cls"] == "directive"),
                                                 lambda x: x["text"]))
    df = df.withColumn("n_main", F.size(F.filter("directives", lambda x: ~x.isin(HEADER_FOOTER))))
    df = df.withColumn("errors", F.size(F.filter("_dc3", lambda x: x["cls"] == "double_todo"))
                       + F.when(F.col("n_main") > 1, 1).otherwise(0))
    df = df.withColumn("warnings", F.aggregate(
        "_dc3", F.lit(0), lambda acc, x: acc + F.when(x["cls"] == "warned", x["warn"]).otherwise(0)))
    # message bodies in the order the reference reports them
    q = F.lit('"')
    per_comment = F.flatten(F.transform("_dc3", lambda x: F.array_compact(F.array(
        F.when(x["cls"] == "double_todo", F.lit(DIRECTIVE_MESSAGES["double_todo"])),
        F.when((x["cls"] == "warned") & x["d"].contains("-"),
               F.concat(F.lit(DIRECTIVE_MESSAGES["hyphen"]), q, x["d"], q, F.lit(": "), x["text"])),
        F.when((x["cls"] == "warned") & ~x["d"].isin(SUPPORTED_DIRECTIVES),
               F.concat(F.lit(DIRECTIVE_MESSAGES["unsupported"]), q, x["d"], q, F.lit(DIRECTIVE_MESSAGES["see"])))))))
    multiple = F.when(F.col("n_main") > 1, F.concat(
        F.lit(DIRECTIVE_MESSAGES["multiple"]), F.col("n_main").cast("string"), F.lit("): ['"),
        F.array_join("directives", "', '"), F.lit("']")))
    df = df.withColumn("messages", F.array_compact(F.concat(per_comment, F.array(multiple))))
    return df.drop("_dc1", "_dc2", "_dc3")


def route(command: Column, directives: Column) -> Column:
    """Targets of a cell: array of 'student' / 'solution' (empty = skipped)."""
    has = lambda d: F.array_contains(directives, d)
    both = F.array(F.lit("student"), F.lit("solution"))
    none = F.array().cast("array<string>")
    return (F.when(py_strip(command) == "", none)
            .when(has(D_SOURCE_ONLY) | has(D_INCLUDE_HEADER_TRUE) | has(D_INCLUDE_HEADER_FALSE)
                  | has(D_INCLUDE_FOOTER_TRUE) | has(D_INCLUDE_FOOTER_FALSE), none)
            .when(has(D_TODO), F.array(F.lit("student")))
            .when(has(D_ANSWER), F.array(F.lit("solution")))
            .otherwise(both))


def with_clean_todo(df: DataFrame, command: str = "command", cm: str = "cm",
                    out: str = "cleaned", errors: str = "todo_errors") -> DataFrame:
    """Uncomment a TODO cell line by line.

    Line 0 must be the TODO directive; other non-blank lines must be
    commented (an offending line is reported and left out); the directive
    line is kept; '<cm> ' or '<cm>' is removed from the rest."""
    c = F.col(cm)
    lines = F.split(F.col(command), "\n", -1)
    # a first line holding a magic (%md, %sql, ...) is kept and the comment
    # prefix becomes '<cm> MAGIC <marker of that language>'; the last match
    # wins.  Only the first line is looked at (cheap even if re-evaluated).
    l0 = F.substring_index(F.col(command), "\n", 1)
    many = F.instr(F.col(command), "\n") > 0
    first, prefix = F.lit(0), c
    for m in ["%r", "%md", "%sql", "%python", "%scala"]:
        hit = many & (l0.startswith(m) | l0.startswith(F.concat(c, F.lit(f" MAGIC {m}"))))
        first = F.when(hit, F.lit(1)).otherwise(first)
        prefix = F.when(hit, F.concat(c, F.lit(f" MAGIC {COMMENT_MARKERS[m[1:]]}"))).otherwise(prefix)
    df = df.withColumn("_ctf", first).withColumn("_ctp", prefix)
    p, n = F.col("_ctp"), F.length(F.col("_ctp"))
    todo = F.concat(p, F.lit(" " + D_TODO))
    magic = F.concat(c, F.lit(" MAGIC"))
    df = df.withColumn("_ct1", F.transform(lines, lambda line, i: F.struct(
        line.alias("line"), py_strip(line).alias("s"), i.alias("i"))))
    df = df.withColumn("_ct2", F.transform("_ct1", lambda x: F.struct(
        x["line"].alias("line"), x["s"].alias("s"), ((x["i"] == 0) & (F.col("_ctf") == 1)).alias("keep"),
        F.when((x["i"] == 0) & (F.col("_ctf") == 1), 0)
         .when((x["i"] == F.col("_ctf")) & (x["s"] != todo), 1)
         .when(~x["line"].startswith(p) & (x["s"] != "") & (x["s"] != magic), 1).otherwise(0).alias("err"))))
    out_line = lambda x: (F.when(x["keep"], x["line"])
                          .when(x["err"] == 1, F.lit(""))
                          .when(x["s"].startswith(todo), x["line"])
                          .when((x["s"] == "") | (x["s"] == magic), x["line"])
                          .when(x["s"].startswith(F.concat(p, F.lit(" "))), tail(x["line"], n + 2))
                          .otherwise(tail(x["line"], n + 1)))
    df = df.withColumn(out, F.array_join(F.transform("_ct2", out_line), "\n"))
    df = df.withColumn(errors, F.aggregate("_ct2", F.lit(0), lambda acc, x: acc + x["err"]))
    return df.drop("_ct1", "_ct2", "_ctf", "_ctp")


def line_of_first(text: Column, what: str) -> Column:
    """The stripped line holding the first occurrence of ``what`` (NULL if absent)."""
    pos = F.instr(text, what)
    before = F.substring_index(F.substring(text, F.lit(1), pos - 1), "\n", -1)
    after = F.substring_index(tail(text, pos), "\n", 1)
    return F.when(pos > 0, py_strip(F.concat(before, after)))


def html_links(html: Column) -> Column:
    """``<a ...</a>`` occurrences; (?d) gives '.' the Python meaning (any char but \\n)."""
    return F.regexp_extract_all(html, F.lit(r"(?d)<a .*?</a>"), 0)


# The i18n rule messages (cell number = position + 1).
GUID_MESSAGES = {
    "single_line": "Cmd #{n} | Expected MD to have more than 1 line of code with i18n enabled: {line0}",
    "missing_directive": "Cmd #{n} | Missing the i18n directive: {line0}",
    "word_count": "Cmd #{n} | Expected the first line of MD to have only two words, found {k}: {line0}",
    "md_tag": 'Cmd #{n} | Expected word[0] of the first line of MD to be "%md" or "%md-sandbox", found {tag}: {line0}',
    "guid_prefix": 'Cmd #{n} | Expected word[1] of the first line of MD to start with "--i18n-", found {guid}: {line0}',
    "duplicate": "Cmd #{n} | Duplicate i18n GUID found: {guid}",
    "no_title": "Cmd #{n} | Missing the i18n directive, no title.",
    "title_words": "Cmd #{n} | Expected the title to have only one word, found {k}: {guid}",
    "title_prefix": 'Cmd #{n} | Expected the cell title to start with "--i18n-", found {guid}: {title}',
}


def with_guid_check(df: DataFrame, command: str = "command", cm: str = "cm") -> DataFrame:
    """Add ``titled``, ``title``, ``guid``, ``md_tag``, ``line0``, ``n_parts``
    and ``error`` -- the first failing i18n rule of a markdown cell (NULL =
    passed; non-markdown cells are not checked).  A cell whose first line is
    ``<cm> DBTITLE …`` carries its guid in the title (after the comma), else
    the guid is the second word of the ``%md`` line.  Staged so each piece is
    computed once."""
    c, cmd = F.col(cm), F.col(command)
    titled = cmd.startswith(F.concat(c, F.lit(" DBTITLE ")))
    nl = F.instr(cmd, "\n")
    df = df.withColumn("titled", titled)
    df = df.withColumn("title", F.when(titled, py_strip(F.substring_index(cmd, "\n", 1))))
    df = df.withColumn("md_body", F.when(titled, py_strip(F.when(nl > 0, tail(cmd, nl + 1))
                                                          .otherwise(F.lit("")))).otherwise(cmd))
    df = df.withColumn("_md", F.col("md_body").startswith(F.concat(c, F.lit(" MAGIC %md"))))
    # body form
    df = df.withColumn("_g1", F.split(py_strip(F.col("md_body")), "\n", -1))
    df = df.withColumn("line0", tail(F.col("_g1")[0], F.length(c) + 8))
    df = df.withColumn("_g2", F.filter(F.split(py_strip(F.col("line0")), " ", -1), lambda p: py_strip(p) != ""))
    df = df.withColumn("_g3", F.struct(F.size("_g2").alias("n"), F.try_element_at("_g2", F.lit(1)).alias("tag"),
                                       py_strip(F.try_element_at("_g2", F.lit(2))).alias("g")))
    n, tag, g = F.col("_g3.n"), F.col("_g3.tag"), F.col("_g3.g")
    body_err = (F.when(F.size("_g1") <= 1, "single_line").when(n == 1, "missing_directive").when(n != 2, "word_count")
                .when(~tag.isin("%md", "%md-sandbox"), "md_tag").when(~g.startswith("--i18n-"), "guid_prefix"))
    # title form
    df = df.withColumn("_t1", F.split(F.col("title"), ",", -1))
    df = df.withColumn("_tg", py_strip(F.try_element_at("_t1", F.lit(2))))
    tg = F.col("_tg")
    tw = F.size(F.split(tg, " ", -1))
    title_err = (F.when((F.size("_t1") == 1) | (tg == ""), "no_title").when(tw != 1, "title_words")
                 .when(~tg.startswith("--i18n-"), "title_prefix"))
    md = F.col("_md")
    return (df.withColumn("guid", F.when(~md, None).when(F.col("titled"), F.when(tg != "", tg))
                          .otherwise(F.when(n >= 2, g)))
            .withColumn("md_tag", tag)
            .withColumn("n_parts", F.when(F.col("titled"), tw).otherwise(n))
            .withColumn("error", F.when(~md, None).when(F.col("titled"), title_err).otherwise(body_err))
            .drop("_md", "_g1", "_g2", "_g3", "_t1", "_tg"))


def guid_findings(cells: DataFrame, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """Rule findings per markdown cell plus duplicate guids within a document
    (the first passing cell of a guid wins): ``error`` and ``message``."""
    g = with_guid_check(cells)
    # first passing cell per (document, guid): a window over one document's
    # cells (bounded by the document), so the check is computed once -- no
    # self-join and no filter on the derived error (which Catalyst would push
    # below the projections and recompute)
    w = Window.partitionBy(doc, "guid")
    j = g.withColumn("_first", F.min(F.when(F.col("error").isNull(), F.col(pos))).over(w))
    j = j.withColumn("error", F.when(F.col("error").isNull() & (F.col(pos) > F.col("_first")), F.lit("duplicate"))
                     .otherwise(F.col("error")))
    n = (F.col(pos) + 1).cast("string")

    def fmt(key):
        t = GUID_MESSAGES[key]
        parts = []
        for chunk in t.replace("{", "\x00{").split("\x00"):
            if chunk.startswith("{"):
                name, rest = chunk[1:].split("}", 1)
                parts.append({"n": n, "line0": F.col("line0"), "k": F.col("n_parts").cast("string"),
                              "tag": F.col("md_tag"), "guid": F.col("guid"), "title": F.col("title")}[name])
                if rest:
                    parts.append(F.lit(rest))
            elif chunk:
                parts.append(F.lit(chunk))
        return F.concat(*parts)

    msg = F.lit(None).cast("string")
    for key in GUID_MESSAGES:
        msg = F.when(F.col("error") == key, fmt(key)).otherwise(msg)
    return j.withColumn("message", msg).drop("_first")


# Messages on link targets.
TARGET_UNEXPECTED = 'Cmd #{n} | Found unexpected, relative, {what} target: "{original}" resolved as "{target}"'
TARGET_MISSING = 'Cmd #{n} | Cannot find notebook for the {what} target: "{original}" resolved as "{target}"'


def fill(template: str, **values) -> Column:
    """A message template with its named placeholders filled from columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(x) if i % 2 == 0 else values[x].cast("string") for i, x in enumerate(parts) if x])


def resolve_target(path: Column, target: Column) -> Column:
    """A ``./`` or ``../`` target seen from the document at ``path``: each
    leading ``../`` goes up one folder; the result has no leading slash."""
    climbs = F.regexp_extract(target, r"^((?:\.\./)*)", 1)
    rest = F.when(climbs != "", tail(target, F.length(climbs) + 1)).when(target.startswith("./"), tail(target, 3)).otherwise(target)
    parts = F.split(path, "/")
    kept = F.greatest(F.size(parts) - 1 - F.length(climbs) / 3, F.lit(0)).cast("int")
    parent = F.array_join(F.slice(parts, F.lit(1), kept), "/")
    return F.regexp_replace(F.when(F.contains(path, F.lit("/")), F.concat(parent, F.lit("/"), rest)).otherwise(rest), "^/", "")


def check_targets(links: DataFrame, paths: DataFrame, what: str, path: str = "path", pos: str = "pos",
                  original: str = "original", target: str = "target") -> DataFrame:
    """``links`` with ``resolved``, ``severity`` and ``message``: a target that
    is neither ``./`` nor ``../`` is a warning, one that resolves to no path of
    ``paths(path)`` and to no folder above one is an error.  Every path is
    exploded into itself and its folders once; then one equi-join."""
    parts = F.split("path", "/")
    lead = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    top = F.when(F.size(parts) == 1, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    known = paths.select(F.explode(F.concat(lead, top)).alias("resolved")).distinct().withColumn("_known", F.lit(True))
    aimed = links.withColumn("_relative", F.col(target).startswith("./") | F.col(target).startswith("../"))
    aimed = aimed.withColumn("resolved", F.when(F.col("_relative"), resolve_target(F.col(path), F.col(target))))
    j = aimed.join(known, "resolved", "left")
    severity = (F.when(F.col(target).isNull(), None).when(~F.col("_relative"), "warning")
                .when(F.col("_known").isNull(), "error"))
    n = F.col(pos) + 1
    message = (F.when(severity == "warning", fill(TARGET_UNEXPECTED, n=n, what=F.lit(what), original=F.col(original), target=F.col(target)))
               .when(severity == "error", fill(TARGET_MISSING, n=n, what=F.lit(what), original=F.col(original), target=F.col("resolved"))))
    return j.withColumn("severity", severity).withColumn("message", message).drop("_relative", "_known")


# The bundle markers that open a segment.
BUNDLE_SPLIT = r"(?m)^<hr>--i18n-|^<hr sandbox>--i18n-"


def _latest(segments):
    """Of an array of (guid, body) in order, the last of each guid: sorted by
    guid and backwards by place, and each compared with its neighbour.  All
    inside the row, so bodies are not shuffled."""
    placed = F.array_sort(F.transform(segments, lambda s, i: F.struct(
        s["guid"].alias("guid"), (-i).alias("back"), s["body"].alias("body"))))
    before = F.concat(F.array(F.lit(None).cast("struct<guid:string,back:int,body:string>")), placed)
    return F.array_compact(F.zip_with(placed, F.slice(before, F.lit(1), F.size(placed)), lambda s, p: F.when(
        p.isNull() | (p["guid"] != s["guid"]), F.struct(s["guid"].alias("guid"), s["body"].alias("body")))))


def bundle_map(b):
    """bundle text -> (doc_id, guid, body): split on the markers, guid up to
    the first newline, later duplicates win (one bundle to a document)."""
    def segment(part):
        nl = F.instr(part, "\n")
        guid = py_strip(F.concat(F.lit("--i18n-"), F.when(nl == 0, part).otherwise(F.substring(part, F.lit(1), nl - 1))))
        return F.struct(guid.alias("guid"), F.when(nl == 0, F.lit("")).otherwise(tail(part, nl + 1)).alias("body"))

    parts = F.split("bundle", BUNDLE_SPLIT, -1)
    found = _latest(F.transform(F.slice(parts, F.lit(2), F.size(parts)), segment))
    return b.select("doc_id", F.inline_outer(found)).where("guid is not null")


#: A line break before a marker line; the first line of a file opens nothing.
SEGMENT_SPLIT = r"\n(?=<hr>--i18n-|<hr sandbox>--i18n-)"


def _segments(text):
    """A file's segments in order, as an array of (guid, body)."""
    def segment(part):
        nl = F.instr(part, "\n")
        line = F.when(nl == 0, part).otherwise(F.substring(part, F.lit(1), nl - 1))
        guid = py_strip(F.when(line.startswith("<hr>--i18n-"), tail(line, 12)).otherwise(tail(line, 20)))
        return F.struct(guid.alias("guid"), F.when(nl == 0, F.lit("")).otherwise(tail(part, nl + 1)).alias("body"))

    parts = F.split(text, SEGMENT_SPLIT, -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), segment)


def read_segments(files):
    """(file, text) -> (file, guid, contents): a marker line opens a segment,
    other lines append to it; line 0 is the file name; a later segment with
    the same guid replaces the earlier one.  Computed inside each file row, in
    time that grows with its length."""
    s = files.select("file", F.inline_outer(_latest(_segments(F.col("text")))))
    return s.where("guid is not null").select("file", "guid", F.col("body").alias("contents"))


def segment_digests(files: DataFrame) -> DataFrame:
    """(file, text) -> one row per file (``_is_file``) plus one per segment
    guid with the SHA-256 of its stripped contents (later duplicates win);
    a single explode per file row, so the files are read once."""
    digests = F.transform(_latest(_segments(F.col("text"))), lambda s: F.struct(
        F.lit(False).alias("_is_file"), s["guid"].alias("guid"), F.sha2(py_strip(s["body"]), 256).alias("h")))
    marker = F.array(F.struct(F.lit(True).alias("_is_file"), F.lit("").alias("guid"), F.sha2(F.lit(""), 256).alias("h")))
    return files.select("file", F.inline(F.concat(marker, F.coalesce(digests, F.array()))))


def segment_diff(original: DataFrame, latest: DataFrame) -> DataFrame:
    """Missing Notebook per file, else Cell Added / Removed / Changed per
    guid (whitespace-stripped compare): one full outer join of the two
    digest sets, then one grouping per file (a file is one document)."""
    a = segment_digests(original).withColumnRenamed("h", "ha")
    b = segment_digests(latest).withColumnRenamed("h", "hb")
    j = a.join(b, ["file", "_is_file", "guid"], "full_outer")
    kind = (F.when(F.col("ha").isNull(), "Cell Added").when(F.col("hb").isNull(), "Cell Removed")
            .when(F.col("ha") != F.col("hb"), "Cell Changed"))
    g = j.groupBy("file").agg(
        F.bool_or(F.col("_is_file") & F.col("ha").isNotNull()).alias("in_a"),
        F.bool_or(F.col("_is_file") & F.col("hb").isNotNull()).alias("in_b"),
        F.collect_list(F.when(~F.col("_is_file") & kind.isNotNull(),
                              F.struct(kind.alias("change_type"), F.col("guid").alias("message")))).alias("ch"))
    missing = lambda side: F.array(F.struct(F.lit("Missing Notebook").alias("change_type"),
                                            F.concat(F.col("file"), F.lit(f" from {side}")).alias("message")))
    out = (F.when(F.col("in_a") & F.col("in_b"), F.col("ch"))
           .when(F.col("in_a"), missing("latest")).otherwise(missing("original")))
    return g.select("file", F.inline(out))


def split_notebooks(df: DataFrame, text: str = "text", language: str = "language") -> DataFrame:
    """Notebook sources -> ordered cells ``(…, pos, command)``: split on the
    language's ``\\n<cm> COMMAND ----------\\n`` delimiter (literal, quoted
    for the regex), after dropping the ``<cm> … notebook source`` first line."""
    cm = comment_marker(F.col(language))
    body = F.regexp_replace(F.col(text), r"^[^\n]* notebook source\n", "")
    delim = F.concat(F.lit("\\Q"), cell_delimiter(cm), F.lit("\\E"))
    parts = F.call_function("split", body, delim, F.lit(-1))
    return df.select("*", F.posexplode(parts).alias("pos", "command"))


def merge_translations(cells: DataFrame, translations: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Markdown cells ``(doc, pos, cm, command)`` with a translation map
    ``(doc, guid, body)``: a passing guid found in the map is replaced by the
    translated body under a ``<cm> DBTITLE 0,<guid>`` title (plus the
    ``<cm> MAGIC %md`` line for the body form); a passing guid missing from
    it keeps its text under that title (status ``missing``, a warning);
    failing cells, duplicates included, stay as they are (``invalid``)."""
    g = guid_findings(cells, doc).select(doc, "pos", "cm", "command", "guid", "error", "md_tag", "titled", "md_body")
    tr = translations.select(doc, "guid", "body").withColumn("_have", F.lit(True))
    j = g.join(tr, [doc, "guid"], "left")
    status = (F.when(F.col("error").isNotNull(), "invalid").when(F.col("_have").isNull(), "missing")
              .otherwise("translated"))
    head = F.concat(F.col("cm"), F.lit(" DBTITLE 0,"), F.col("guid"), F.lit("\n"))
    magic = F.concat(F.col("cm"), F.lit(" MAGIC "), F.col("md_tag"), F.lit("\n"))
    text = F.when(status == "translated", F.col("body")).otherwise(
        F.when(F.col("titled"), F.col("md_body")).otherwise(py_strip(F.col("command"))))
    new = (F.when(status == "invalid", F.col("command"))
           .when(F.col("titled"), F.concat(head, text))
           .otherwise(F.concat(head, magic, text)))
    return j.select(doc, "pos", "cm", "guid", "command", status.alias("status"), new.alias("cell"))


# Per notebook language the magic that must not appear in its
# own cells, and the warning text.
OWN_MAGICS = (("python", "%python", 'Found "%python" in a Python notebook'),
              ("sql", "%sql", 'Found "%sql" in a SQL notebook'),
              ("scala", "%scala", 'Found "%scala" in a Scala notebook'),
              ("r", "%r ", 'Found "%r" in an R notebook'),
              ("r", "%r\n", 'Found "%r" in an R notebook'))


def magic_findings(cells: DataFrame, command: str = "command", cm: str = "cm", language: str = "language",
                   pos: str = "pos") -> DataFrame:
    """Warnings for a cell (other than a markdown cell) that names its own
    notebook language's magic; R cells are checked for '%r ' and '%r\\n'
    separately.  One projection and an explode, no join."""
    cmd, lang = F.col(command), F.lower(F.col(language))
    not_md = ~cmd.startswith(F.concat(F.col(cm), F.lit(" MAGIC %md")))
    checks = []
    for name, token, text in OWN_MAGICS:
        hit = not_md & (lang == name) & (F.instr(cmd, token) > 0)
        checks.append(F.when(hit, F.concat(F.lit("Cmd #"), (F.col(pos) + 1).cast("string"), F.lit(f" | {text}"))))
    return cells.select("*", F.explode(F.array_compact(F.array(*checks))).alias("warning"))


# The line that opens a change log, and the start of its headers.
CHANGE_LOG_TAG = "## Change Log"
CHANGE_LOG_VERSION = "### Version "


def change_log(df: DataFrame, lines: str, wanted: str) -> DataFrame:
    """``df`` with ``version, date, entries, error`` of its change log, an
    array of lines.  Below the tag, every line that is neither empty nor an
    entry must be a header ``### Version N.N.N (M-D-YYYY)``, or ``(TBD)``, up
    to the ``wanted`` version (null: the first); its entries run to the next
    heading.  ``error``: no_version, parts or version (a malformed header on
    the way), date, no_entries, not_found; null if all is well."""
    d = df.withColumn("_ls", F.transform(lines, py_strip))
    d = d.withColumn("_tag", F.array_position("_ls", CHANGE_LOG_TAG))
    numbered = F.transform("_ls", lambda x, i: F.struct((i + 1).alias("i"), x.alias("line")))
    heads = F.filter(numbered, lambda x: (F.col("_tag") > 1) & (x["i"] > F.col("_tag")) & (x["line"] != "") & ~x["line"].startswith("* "))

    def judged(x):
        parts = F.split(x["line"], " ", -1)
        error = (F.when(~x["line"].startswith(CHANGE_LOG_VERSION), "no_version").when(F.size(parts) != 4, "parts")
                 .when(~F.get(parts, 2).rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$"), "version"))
        return F.struct(x["i"].alias("i"), F.get(parts, 2).alias("version"), F.get(parts, 3).alias("date"), error.alias("error"))

    d = d.withColumn("_heads", F.transform(heads, judged))
    hit = F.filter("_heads", lambda h: h["error"].isNull() & (F.col(wanted).isNull() | h["version"].eqNullSafe(F.col(wanted))))
    bad = F.filter("_heads", lambda h: h["error"].isNotNull())
    d = d.withColumn("_hit", F.get(hit, 0)).withColumn("_bad", F.get(bad, 0))
    early = F.col("_bad").isNotNull() & (F.col("_hit").isNull() | (F.col("_bad.i") < F.col("_hit.i")))
    d = d.withColumn("_at", F.when(~early, F.col("_hit")))
    after = F.slice("_ls", F.col("_at.i") + 1, F.size("_ls"))
    ends = F.filter(F.transform(after, lambda x, i: F.when(x.startswith("#"), i)), lambda i: i.isNotNull())
    entries = F.filter(F.slice(after, F.lit(1), F.coalesce(F.get(ends, 0), F.size(after))), lambda x: x != "")
    d = d.withColumn("entries", F.coalesce(entries, F.array().cast("array<string>")))
    date = F.col("_at.date")
    error = (F.when(early, F.col("_bad.error")).when(F.col("_hit").isNull(), "not_found")
             .when((date != "(TBD)") & ~date.rlike(r"^\([0-9]+-[0-9]+-[0-9]+\)$"), "date").when(F.size("entries") == 0, "no_entries"))
    return d.select(*df.columns, F.col("_at.version").alias("version"), F.substring(date, F.lit(2), F.length(date) - 2).alias("date"),
                    "entries", error.alias("error"))


# Messages on what publishing leaves behind, and what it looks for.
LEFT_PLACEHOLDER = "A mustache pattern was detected after all replacements were processed: {what}"
LEFT_ICON = "The deprecated {what} pattern was found after all replacements were processed."
BAD_PATH = "Found invalid character {what} in notebook name: {path}"
NO_TRANSLATION = 'The GUID "{guid}" was not found for the translation of {language}'
PLACEHOLDER = r"\{\{[a-zA-Z\-\\_#/]*\}\}"
ICONS = [":HINT:", ":CAUTION:", ":BESTPRACTICE:", ":SIDENOTE:", ":NOTE:"]
PATH_CHARACTERS = ['"', "*", "<", ">", "?", "\\", "|", ":"]
MARKER_LEFT = 'Cmd #{n} | Found the "--i18n-" marker but i18n processing is disabled.'
TITLE_LEFT = "Cmd #{n} | Cell titles are only supported for translated courses, please remove to continue."


def replaced(text: Column, replacements: dict[str, str]) -> Column:
    """``{{name}}`` by its value, one name after the other."""
    for name, value in replacements.items():
        text = F.replace(text, F.lit("{{" + name + "}}"), F.lit(value))
    return text


def left_overs(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep, kind, what, message`` for what is left in a text after all
    replacements: the first placeholder, and each deprecated icon.  One
    projection, nothing is shuffled; null texts have no findings."""
    first = F.regexp_extract(text, f"({PLACEHOLDER})", 1)
    kinds = [F.when(first != "", F.struct(F.lit("placeholder").alias("kind"), first.alias("what"), fill(LEFT_PLACEHOLDER, what=first).alias("message")))]
    kinds += [F.when(F.contains(text, F.lit(i)), F.struct(F.lit("icon").alias("kind"), F.lit(i).alias("what"), F.lit(LEFT_ICON.format(what=i)).alias("message")))
              for i in ICONS]
    return df.select(*keep, F.inline(F.array_compact(F.array(*kinds))))


def path_findings(df: DataFrame, path: str, keep: list[str]) -> DataFrame:
    """``keep, what, message`` for each character that a notebook name must not hold."""
    found = F.array_compact(F.array(*[F.when(F.contains(path, F.lit(c)), F.lit(c)) for c in PATH_CHARACTERS]))
    return df.select(*keep, F.col(path).alias("_p"), F.explode(found).alias("what")).select(
        *keep, "what", fill(BAD_PATH, what=F.col("what"), path=F.col("_p")).alias("message"))


def missing_translations(merged: DataFrame, language: str, doc: str = "doc_id") -> DataFrame:
    """``doc, pos, guid, message`` for passing guids that the bundle lacks
    (``merged`` as of :func:`merge_translations`)."""
    return merged.where("status = 'missing'").select(doc, "pos", "guid", fill(NO_TRANSLATION, guid=F.col("guid"), language=F.lit(language)).alias("message"))


# Ways to publish.
PUBLISH_MODES = ["translated", "standard", "plain"]


def published_cells(cells: DataFrame, mode: str, translations: DataFrame | None = None, doc: str = "doc_id") -> DataFrame:
    """``doc, pos, cm, cell, message`` of all cells, code and markdown alike.

    ``translated`` takes bodies from ``translations`` as :func:`merge_translations`
    does; ``standard`` publishes in the language of the source: the i18n word goes
    and the guid becomes the title; ``plain``, with i18n switched off, leaves cells
    as they are and reports titles and markers.  With i18n on, a code cell loses
    its title line.  ``message`` is the finding of the cell, if any."""
    n = (F.col("pos") + 1).cast("string")
    titled = F.col("command").startswith(F.concat("cm", F.lit(" DBTITLE ")))
    markdown = F.col("command").startswith(F.concat("cm", F.lit(" MAGIC %md")))
    if mode == "plain":
        msg = F.when(F.contains("command", F.lit("DBTITLE")), fill(TITLE_LEFT, n=n)).when(
            markdown & F.contains("command", F.lit("--i18n-")), fill(MARKER_LEFT, n=n))
        return cells.select(doc, "pos", "cm", F.col("command").alias("cell"), msg.alias("message"))
    g = guid_findings(cells, doc).select(doc, "pos", "cm", "command", "guid", "error", "md_tag", "titled", "md_body", "message")
    md = F.col("md_body").startswith(F.concat("cm", F.lit(" MAGIC %md")))
    if mode == "translated":
        j = g.join(translations.select(doc, "guid", "body"), [doc, "guid"], "left")
    else:
        j = g.withColumn("body", F.lit(None).cast("string"))
    head = F.concat("cm", F.lit(" DBTITLE 0,"), "guid", F.lit("\n"))
    magic = F.concat("cm", F.lit(" MAGIC "), "md_tag", F.lit("\n"))
    whole = py_strip(F.col("command"))
    if mode == "translated":
        rest, kept = F.coalesce("body", whole), F.coalesce("body", "md_body")
    else:
        rest, kept = tail(whole, F.instr(whole, "\n") + 1), F.col("md_body")
    new = (F.when(~md, F.when(F.col("titled"), F.col("md_body")).otherwise(F.col("command")))
           .when(F.col("error").isNotNull(), F.col("command"))
           .when(F.col("titled"), F.concat(head, kept)).otherwise(F.concat(head, magic, rest)))
    return j.select(doc, "pos", "cm", new.alias("cell"), F.when(md, F.col("message")).alias("message"))


def joined_document(cells: DataFrame, header: str, doc: str = "doc_id") -> DataFrame:
    """``doc, n_cells, n_findings, document``: the cells of a document in order,
    under its header line, joined with the delimiter of its language."""
    g = cells.groupBy(doc).agg(F.count(F.lit(1)).alias("n_cells"), F.count("message").alias("n_findings"), F.min("cm").alias("cm"),
                               F.sort_array(F.collect_list(F.struct("pos", "cell"))).alias("_c"))
    text = F.concat("cm", F.lit(header), F.call_function("array_join", F.transform("_c", lambda x: x["cell"]), cell_delimiter(F.col("cm"))))
    return g.select(doc, "n_cells", "n_findings", text.alias("document"))
