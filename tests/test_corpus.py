"""Corpus builders against hand-made cells; message texts must be as given."""

from pyspark.sql import functions as F

from assay.operators import corpus as K
from assay.operators.reports import severity_label


def cells(spark, rows):
    return spark.createDataFrame(rows, "id int, cm string, command string")


def test_directives_and_findings(spark):
    df = cells(spark, [
        (1, "#", "# TODO\n# x = 1"),
        (2, "#", "# # TODO\n# x = 1"),                 # double comment -> error
        (3, "--", "-- ANSWER\n-- INCLUDE_HEADER_TRUE\nSELECT 1"),
        (4, "#", "# WIP-NOTE\nprint(1)"),              # hyphen + unsupported -> two warnings
        (5, "#", "# SELECT\n# FILL-IN\n# todo lower\nx"),
        (6, "#", "# TODO\n# ANSWER\nx"),               # two directives -> error
    ])
    d = K.with_directives(K.with_leading_comments(df))
    got = {r.id: (r.directives, r.errors, r.warnings) for r in d.collect()}
    assert got[1] == (["TODO"], 0, 0)
    assert got[2] == ([], 1, 0)
    assert got[3] == (["ANSWER", "INCLUDE_HEADER_TRUE"], 0, 0)
    assert got[4] == ([], 0, 2)
    assert got[5] == ([], 0, 0)
    assert got[6] == (["TODO", "ANSWER"], 1, 0)


def test_routing(spark):
    df = cells(spark, [(1, "#", "# TODO\nx"), (2, "#", "# ANSWER\nx"), (3, "#", "# SOURCE_ONLY\nx"),
                       (4, "#", "print(1)"), (5, "#", "   ")])
    d = K.with_directives(K.with_leading_comments(df))
    got = {r.id: r.t for r in d.select("id", K.route(F.col("command"), F.col("directives")).alias("t")).collect()}
    assert got == {1: ["student"], 2: ["solution"], 3: [], 4: ["student", "solution"], 5: []}


def test_clean_todo(spark):
    df = cells(spark, [(1, "#", "# TODO\n# x = 1\n#y = 2\n\n# MAGIC"), (2, "#", "# TODO\nx = 1"), (3, "#", "x\n# y")])
    got = {r.id: (r.cleaned, r.todo_errors) for r in K.with_clean_todo(df).collect()}
    assert got[1] == ("# TODO\nx = 1\ny = 2\n\n# MAGIC", 0)
    assert got[2] == ("# TODO\n", 1)           # an uncommented line is reported and left out
    assert got[3][1] == 1                      # first line must be the directive


def test_line_of_first_and_links(spark):
    df = spark.createDataFrame([('a\n  b "/mnt/x" c  \nd "/mnt/x"',)], "t string")
    row = df.select(K.line_of_first(F.col("t"), '"/mnt/x"').alias("l"),
                    K.line_of_first(F.col("t"), "zzz").alias("n")).first()
    assert row.l == 'b "/mnt/x" c' and row.n is None
    h = spark.createDataFrame([('<a href="/x">1</a> <a\nhref="/y">2</a><a target="_blank" href="z">3</a>',)], "h string")
    links = h.select(K.html_links(F.col("h"))).first()[0]
    assert links == ['<a href="/x">1</a>', '<a target="_blank" href="z">3</a>']   # '.' does not cross lines


def test_comment_marker_substring_quirk(spark):
    df = spark.createDataFrame([("python",), ("",), ("sql",), ("scala",), ("r",), ("md",)], "l string")
    got = [r[0] for r in df.select(K.comment_marker(F.col("l"))).collect()]
    assert got == ["#", "#", "--", "//", "#", "--"]


def test_severity_label_goldens(spark):
    df = spark.createDataFrame([(1, 2, 7), (3, 0, 0)], "w int, e int, x int")
    got = [(r.l, r.c) for r in df.select(
        severity_label(F.col("w"), F.col("e"), F.col("x")).alias("l"),
        F.when((F.col("e") > 0) | (F.col("x") > 0), "danger").otherwise("warning").alias("c")).collect()]
    assert got == [("| 7 Exceptions | 2 Errors | 1 Warnings |", "danger"), ("| 3 Warnings |", "warning")]


GUID = "--i18n-00000000-aaaa-4bbb-8ccc-0123456789ab"


def guid_rows(spark, cells):
    df = spark.createDataFrame([(1, i, cm, c) for i, (cm, c) in enumerate(cells)], "doc_id int, pos int, cm string, command string")
    return [(r.error, r.message) for r in K.guid_findings(df).orderBy("pos").collect()]


HEAD = "Word counts of a line"


def test_guid_rules_of_a_body(spark):
    single = "Cmd #1 | Expected MD to have more than 1 line of code with i18n enabled: "
    cases = [
        (("#", f"# MAGIC %md {GUID}\n# MAGIC {HEAD}"), (None, None)),
        (("#", f"# MAGIC %md    {GUID}\n# MAGIC\n# MAGIC {HEAD}"), (None, None)),
        (("--", f"-- MAGIC %md-sandbox {GUID}\n-- MAGIC {HEAD}\n-- MAGIC and more"), (None, None)),
        (("#", f"# MAGIC %md\n# MAGIC {HEAD}"), ("missing_directive", "Cmd #1 | Missing the i18n directive: %md")),
        (("#", "# MAGIC %md *one*"), ("single_line", single + "%md *one*")),
        (("--", f"-- MAGIC %md {GUID}"), ("single_line", single + f"%md {GUID}")),
        (("#", f"# MAGIC %md {GUID} a b c\n# MAGIC {HEAD}"),
         ("word_count", f"Cmd #1 | Expected the first line of MD to have only two words, found 5: %md {GUID} a b c")),
    ]
    for cell, want in cases:
        assert guid_rows(spark, [cell]) == [want], cell


def test_repeated_guids(spark):
    other = GUID.replace("0000", "1111")
    cell = lambda g: ("#", f"# MAGIC %md {g}\n# MAGIC {HEAD}")
    assert guid_rows(spark, [cell(GUID), cell(other)]) == [(None, None), (None, None)]
    got = guid_rows(spark, [cell(GUID), ("#", "a = 1"), cell(GUID), cell(other), cell(GUID)])
    assert [e for e, _ in got] == [None, got[1][0], "duplicate", None, "duplicate"]
    assert got[2][1] == f"Cmd #3 | Duplicate i18n GUID found: {GUID}" and got[4][1] == f"Cmd #5 | Duplicate i18n GUID found: {GUID}"


def test_links_of_a_cell(spark):
    link = '<a href="/p/{}" target="_blank">{}</a>'
    texts = ["none here", link.format(1, "x"), f"{link.format(1, 'x')} and {link.format(2, 'y')}\n{link.format(3, 'z')}", "<a>broken", "<abbr>no</abbr>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [len(r[0]) for r in df.select(K.html_links(F.col("t"))).collect()] == [0, 1, 3, 0, 0]


def test_magic_cells(spark):
    df = cells(spark, [(1, "#", "# MAGIC %sql\n# MAGIC -- TODO\n# MAGIC -- SELECT 1"),
                       (2, "#", "# MAGIC %md\n# MAGIC # Heading\n# MAGIC text")])
    d = K.with_directives(K.with_leading_comments(df))
    got = {r.id: r.directives for r in d.collect()}
    assert got == {1: ["TODO"], 2: []}      # '#' is a comment in python cells, not in %md cells
    cleaned = {r.id: (r.cleaned, r.todo_errors) for r in K.with_clean_todo(df).collect()}
    assert cleaned[1] == ("# MAGIC %sql\n# MAGIC -- TODO\nSELECT 1", 0)


def test_split_notebooks_round_trip(spark):
    src = "# notebook source\n# MAGIC %md\n# MAGIC x\n\n# COMMAND ----------\n\nprint(1)\n\n# COMMAND ----------\n\n# TODO"
    sql = "-- notebook source\nSELECT 1\n\n-- COMMAND ----------\n\nSELECT 2"
    df = spark.createDataFrame([(1, "python", src), (2, "sql", sql)], "id int, language string, text string")
    got = [(r.id, r.pos, r.command) for r in K.split_notebooks(df).orderBy("id", "pos").collect()]
    assert got == [(1, 0, "# MAGIC %md\n# MAGIC x\n"), (1, 1, "\nprint(1)\n"), (1, 2, "\n# TODO"),
                   (2, 0, "SELECT 1\n"), (2, 1, "\nSELECT 2")]


def test_guid_rules_of_a_title(spark):
    body = f"\n# MAGIC %md\n# MAGIC {HEAD}"
    none = ("no_title", "Cmd #1 | Missing the i18n directive, no title.")
    cases = [
        (("#", f"# DBTITLE 1,{GUID}{body}"), (None, None)), (("#", f"# DBTITLE 0,   {GUID}{body}"), (None, None)),
        (("--", f"-- DBTITLE 1,{GUID}\n-- MAGIC %md-sandbox\n-- MAGIC {HEAD}"), (None, None)),
        (("#", f"# DBTITLE 1{body}"), none), (("#", f"# DBTITLE 1,{body}"), none), (("#", "# DBTITLE 1,plots\nshow()"), (None, None)),
        (("#", f"# DBTITLE 1,{GUID} of mine{body}"), ("title_words", f"Cmd #1 | Expected the title to have only one word, found 3: {GUID} of mine")),
    ]
    for cell, want in cases:
        assert guid_rows(spark, [cell]) == [want], cell
    twice = ("#", f"# DBTITLE 1,{GUID}{body}")
    assert guid_rows(spark, [twice, twice])[1] == ("duplicate", f"Cmd #2 | Duplicate i18n GUID found: {GUID}")


def test_translations_replace_cells(spark):
    made = spark.createDataFrame([
        (1, 0, "#", f"# MAGIC %md {GUID}\n# MAGIC {HEAD}"), (2, 0, "--", f"-- MAGIC %md-sandbox {GUID}\n-- MAGIC {HEAD}"),
        (3, 0, "#", f"# DBTITLE 1,{GUID}\n# MAGIC %md\n# MAGIC {HEAD}"), (4, 0, "#", f"# MAGIC %md {GUID}\n# MAGIC {HEAD}"),
    ], "doc_id int, pos int, cm string, command string")
    tr = spark.createDataFrame([(1, GUID, "# MAGIC Mots par ligne"), (2, GUID, "-- MAGIC Mots"), (3, GUID, "Mots"), (9, GUID, "x")],
                               "doc_id int, guid string, body string")
    got = {r.doc_id: (r.status, r.cell) for r in K.merge_translations(made, tr).collect()}
    assert got[1] == ("translated", f"# DBTITLE 0,{GUID}\n# MAGIC %md\n# MAGIC Mots par ligne")
    assert got[2] == ("translated", f"-- DBTITLE 0,{GUID}\n-- MAGIC %md-sandbox\n-- MAGIC Mots")
    assert got[3] == ("translated", f"# DBTITLE 0,{GUID}\nMots")
    assert got[4][0] == "missing" and HEAD in got[4][1]


def test_magic_findings(spark):
    df = spark.createDataFrame([(0, "#", "python", "x = 1\n# MAGIC %python"), (1, "#", "python", "# MAGIC %md %python"),
                                (2, "#", "r", "%r a\n%r\nb"), (3, "--", "sql", "SELECT '%sql'")],
                               "pos int, cm string, language string, command string")
    got = sorted((r.pos, r.warning) for r in K.magic_findings(df).collect())
    assert got == [(0, 'Cmd #1 | Found "%python" in a Python notebook'), (2, 'Cmd #3 | Found "%r" in an R notebook'),
                   (2, 'Cmd #3 | Found "%r" in an R notebook'), (3, 'Cmd #4 | Found "%sql" in a SQL notebook')]


def test_directive_messages(spark):
    df = cells(spark, [(2, "#", "# # TODO\n# x = 1"), (4, "#", "# WIP-NOTE\nprint(1)"), (6, "#", "# TODO\n# ANSWER\nx")])
    d = K.with_directives(K.with_leading_comments(df))
    got = {r.id: r.messages for r in d.collect()}
    assert got[2] == ["Found double-comment of TODO directive"]
    assert got[4] == ['Hyphen found in directive "WIP-NOTE": WIP-NOTE',
                      'Unsupported directive "WIP-NOTE", see the publishing help for more information.']
    assert got[6] == ["Found multiple directives (2): ['TODO', 'ANSWER']"]


def test_segment_diff_operator(spark):
    a = spark.createDataFrame([
        ("x.md", "x.md\n<hr>--i18n-1\nsame\n<hr>--i18n-2\nold text\n<hr>--i18n-3\ngone"),
        ("only_a.md", "only_a.md\n<hr>--i18n-9\nz"),
    ], "file string, text string")
    b = spark.createDataFrame([
        ("x.md", "x.md\n<hr>--i18n-1\n  same  \n<hr>--i18n-2\nnew text\n<hr sandbox>--i18n-4\nadded"),
        ("only_b.md", "only_b.md\n<hr>--i18n-8\ny"),
    ], "file string, text string")
    got = sorted((r.file, r.change_type, r.message) for r in K.segment_diff(a, b).collect())
    assert got == [("only_a.md", "Missing Notebook", "only_a.md from latest"),
                   ("only_b.md", "Missing Notebook", "only_b.md from original"),
                   ("x.md", "Cell Added", "4"), ("x.md", "Cell Changed", "2"), ("x.md", "Cell Removed", "3")]


def test_segments_in_linear_time_on_a_scanned_table(spark, tmp_path):
    """20,000 lines with a marker every ten, read from a table as a plan would."""
    import time

    lines = ["f.md"] + [f"<hr>--i18n-{i // 10 % 1500}" if i % 10 == 0 else f"line {i}" for i in range(20_000)]
    spark.createDataFrame([("f.md", "\n".join(lines)), ("e.md", "e.md\nnothing"), ("n.md", None), ("z.md", "")], "file string, text string").write.parquet(str(tmp_path / "t"))
    began = time.time()
    got = {(r.file, r.guid): r.contents for r in K.read_segments(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert time.time() - began < 30
    want, guid = {}, None
    for line in lines[1:]:
        if line.startswith("<hr>--i18n-"):
            guid = line[len("<hr>--i18n-"):]
            want["f.md", guid] = []
        else:
            want["f.md", guid].append(line)
    assert got == {k: "\n".join(v) for k, v in want.items()}


def test_relative_targets(spark):
    """Targets from a/b/c: one folder up for each ../, folders count as found, others are told."""
    paths = spark.createDataFrame([("a/b/c",), ("a/d",), ("x/y/z",), ("top",)], "path string")
    want = {"./c": "a/b/c", "../d": "a/d", "../../x/y": "x/y", "../../x": "x", "../b": "a/b", "../../top": "top", "../../../top": "top",
            "./q": None, "../c": None, "d": "warn", "/a/d": "warn", "..d": "warn", "../": None, "./": None}
    links = spark.createDataFrame([(i, "a/b/c", t) for i, t in enumerate(want)], "pos int, path string, target string")
    got = {r.target: r for r in K.check_targets(links, paths, "MD link", original="target").collect()}
    for t, found in want.items():
        assert got[t].severity == {None: "error", "warn": "warning"}.get(found), t
        if found not in (None, "warn"):
            assert got[t].resolved == found and got[t].message is None
    assert got["./q"].message == 'Cmd #8 | Cannot find notebook for the MD link target: "./q" resolved as "a/b/q"'
    assert got["d"].message == 'Cmd #10 | Found unexpected, relative, MD link target: "d" resolved as "d"'
    flat = spark.createDataFrame([(0, "top", "./top"), (1, "top", "../nb")], "pos int, path string, target string")
    assert {r.pos: (r.resolved, r.severity) for r in K.check_targets(flat, paths, "x", original="target").collect()} == {0: ("top", None), 1: ("nb", "error")}


def test_change_log_versions_and_errors(spark):
    log = ["# t", "## Change Log", "", "### Version 1.10.0 (TBD)", "* a", "", "note", "### Version 1.9.0 (1-2-2024)", "* b", "## Other", "* c"]
    rows = {"first": (log, None), "words between": (log, "1.9.0"), "second": ([x for x in log if x != "note"], "1.9.0"), "unknown": (log, "2.0.0"), "no tag": (["# t", "### Version 1.0.0 (TBD)", "* x"], None),
            "loose line": (["# t", "## Change Log", "* early", "words", "### Version 1.0.0 (TBD)", "* x"], None),
            "parts": (["# t", "## Change Log", "### Version 1.0.0", "* x"], None), "letters": (["# t", "## Change Log", "### Version 1.b.0 (TBD)", "* x"], None),
            "date": (["# t", "## Change Log", "### Version 1.0.0 (May)", "* x"], None), "bare": (["# t", "## Change Log", "### Version 1.0.0 (TBD)", "# end"], None), "none": (None, None)}
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "k string, ls array<string>, w string")
    got = {r.k: (r.version, r.date, list(r.entries), r.error) for r in K.change_log(df, "ls", "w").collect()}
    assert got == {"first": ("1.10.0", "TBD", ["* a", "note"], None), "second": ("1.9.0", "1-2-2024", ["* b"], None), "words between": (None, None, [], "no_version"), "unknown": (None, None, [], "no_version"),
                   "no tag": (None, None, [], "not_found"), "loose line": (None, None, [], "no_version"), "parts": (None, None, [], "parts"),
                   "letters": (None, None, [], "version"), "date": ("1.0.0", "May", ["* x"], "date"), "bare": ("1.0.0", "TBD", [], "no_entries"),
                   "none": (None, None, [], "not_found")}


def test_left_overs_paths_and_modes(spark):
    from assay.operators import corpus as K

    df = spark.createDataFrame([(1, "a {{x}} {{y-z}} :NOTE: :HINT:"), (2, "{{x}}"), (3, "{{not 1}}"), (4, None)], "i int, t string")
    df = df.withColumn("t", K.replaced(F.col("t"), {"x": "X"}))
    got = sorted((r.i, r.kind, r.what) for r in K.left_overs(df, "t", ["i"]).collect())
    assert got == [(1, "icon", ":HINT:"), (1, "icon", ":NOTE:"), (1, "placeholder", "{{y-z}}")]
    p = spark.createDataFrame([("a/b",), ('a:"b?',), ("c\\d|<>*",), (None,)], "p string")
    assert sorted((r.what, r.message) for r in K.path_findings(p, "p", []).collect()) == sorted(
        (c, f"Found invalid character {c} in notebook name: {x}") for x in ('a:"b?', "c\\d|<>*") for c in K.PATH_CHARACTERS if c in x)
    cells = spark.createDataFrame([(1, 0, "#", "# MAGIC %md --i18n-g1\n# MAGIC Hello"), (1, 1, "#", "# DBTITLE 1,Step\nx = 1"),
                                   (1, 2, "#", "# DBTITLE 1, --i18n-g2\n# MAGIC %md\n# MAGIC Bye"), (1, 3, "#", "y = 2"),
                                   (1, 4, "#", "# MAGIC %md\n# MAGIC none")], "doc_id int, pos int, cm string, command string")
    tr = spark.createDataFrame([(1, "--i18n-g1", "# MAGIC Hola")], "doc_id int, guid string, body string")
    of = lambda mode: {r.pos: (r.cell, r.message is not None) for r in K.published_cells(cells, mode, tr).collect()}
    code = {1: ("x = 1", False), 3: ("y = 2", False), 4: ("# MAGIC %md\n# MAGIC none", True)}
    assert of("translated") == code | {0: ("# DBTITLE 0,--i18n-g1\n# MAGIC %md\n# MAGIC Hola", False), 2: ("# DBTITLE 0,--i18n-g2\n# MAGIC %md\n# MAGIC Bye", False)}
    assert of("standard") == code | {0: ("# DBTITLE 0,--i18n-g1\n# MAGIC %md\n# MAGIC Hello", False), 2: ("# DBTITLE 0,--i18n-g2\n# MAGIC %md\n# MAGIC Bye", False)}
    plain = of("plain")
    assert [plain[i][0] for i in range(5)] == [r.command for r in cells.orderBy("pos").collect()] and [plain[i][1] for i in range(5)] == [True, True, True, False, False]
