"""DuckDB oracle fragments for the corpus jobs (written independently of the
Column builders: list lambdas instead of higher-order Columns)."""

from __future__ import annotations

from assay.operators import corpus as K


def strip(x: str) -> str:
    return "regexp_replace(" + x + ", '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')"


def lst(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


# conversations -> notebook cells with directive headers
CELLS_SQL = """
SELECT conv_id AS doc_id, CAST(turn AS BIGINT) AS pos, role, text,
  CASE conv_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'sql' WHEN 2 THEN 'scala' ELSE 'r' END AS language,
  CASE conv_id % 4 WHEN 0 THEN '#' WHEN 1 THEN '--' WHEN 2 THEN '//' ELSE '#' END AS cm
FROM conversations"""

COMMANDS_SQL = f"""
SELECT *,
  CASE (doc_id + pos) % 11 WHEN 0 THEN cm || ' INCLUDE_HEADER_TRUE' || chr(10)
    WHEN 5 THEN cm || ' INCLUDE_FOOTER_TRUE' || chr(10) ELSE '' END ||
  CASE WHEN role = 'user' AND (doc_id + pos) % 5 = 0 AND cm = '#' THEN
    cm || ' MAGIC %sql' || chr(10) || cm || ' MAGIC -- TODO' || chr(10) ||
    array_to_string(list_transform(string_split(text, chr(10)), lambda l: cm || ' MAGIC -- ' || l), chr(10))
  ELSE
  CASE WHEN (doc_id + pos) % 13 = 0 THEN cm || ' WIP-NOTE'
       WHEN role = 'user' AND (doc_id + pos) % 7 = 0 THEN cm || ' ' || cm || ' TODO'
       WHEN role = 'user' THEN cm || ' TODO'
       WHEN role = 'assistant' THEN cm || ' ANSWER'
       ELSE cm || ' SOURCE_ONLY' END || chr(10) ||
  CASE WHEN role = 'user' THEN array_to_string(list_transform(string_split(text, chr(10)), lambda l: cm || ' ' || l), chr(10))
       ELSE text END ||
  CASE WHEN role = 'system' AND (doc_id + pos) % 3 = 0 THEN chr(10) || cm || ' MAGIC %' || language || ' x' ELSE '' END
  END AS command
FROM ({CELLS_SQL})"""


def _kind(line: str) -> str:
    l1 = (f"(CASE WHEN starts_with({line}, cm || ' MAGIC') THEN {strip(f'substr({line}, length(cm) + 7)')} "
          f"WHEN starts_with({line}, cm || ' COMMAND') THEN {strip(f'substr({line}, length(cm) + 9)')} ELSE {line} END)")
    l2 = (f"(CASE WHEN starts_with({strip(l1)}, '%') THEN (CASE WHEN position(' ' IN {l1}) = 0 THEN '' "
          f"ELSE {strip(f'substr({l1}, position(chr(32) IN {l1}))')} END) ELSE {l1} END)")
    s = strip(l2)
    return (f"{{'kind': CASE WHEN {s} = cell_m OR {s} = '' THEN 'skip' WHEN starts_with({s}, cell_m) THEN 'comment' ELSE 'stop' END, "
            f"'text': {strip(f'substr({s}, length(cell_m) + 1)')}}}")


def cell_marker_sql(command: str = "command") -> str:
    first = f"lower(string_split({strip(command)}, chr(10))[1])"
    return (f"CASE WHEN starts_with({first}, cm || ' magic %md') THEN '--' "
            f"WHEN starts_with({first}, cm || ' magic %sql') THEN '--' "
            f"WHEN starts_with({first}, cm || ' magic %python') THEN '#' "
            f"WHEN starts_with({first}, cm || ' magic %scala') THEN '//' "
            f"WHEN starts_with({first}, cm || ' magic %run') THEN cm "
            f"WHEN starts_with({first}, cm || ' magic %r') THEN '#' ELSE cm END")


def comments_sql(command: str = "command") -> str:
    kinds = f"list_transform(string_split({strip(command)}, chr(10)), lambda l: {_kind('l')})"
    return f"""list_transform(list_filter(
      CASE WHEN list_position(list_transform({kinds}, lambda k: k.kind = 'stop'), true) IS NULL THEN {kinds}
           ELSE ({kinds})[1:list_position(list_transform({kinds}, lambda k: k.kind = 'stop'), true) - 1] END,
      lambda k: k.kind = 'comment'), lambda k: k.text)"""


def classify_sql(c: str) -> str:
    mod = f"regexp_replace({c}, '[^-a-zA-Z_]', '_', 'g')"
    warn = (f"((CASE WHEN contains({c}, '-') THEN 1 ELSE 0 END) + "
            f"(CASE WHEN {c} NOT IN {lst(K.SUPPORTED_DIRECTIVES)} THEN 1 ELSE 0 END))")
    cls = (f"CASE WHEN {c} <> upper({c}) THEN 'none' WHEN {c} IN {lst(K.SQL_WORDS)} THEN 'none' "
           f"WHEN {c} IN {lst(K.ACCEPTED_DIRECTIVES)} THEN 'directive' "
           f"WHEN contains({c}, 'FILL-IN') OR contains({c}, 'FILL_IN') THEN 'none' "
           f"WHEN {c} <> {mod} THEN (CASE WHEN {mod} IN ('__TODO', '___TODO') THEN 'double_todo' ELSE 'none' END) "
           f"WHEN {warn} > 0 THEN 'warned' ELSE 'directive' END")
    return f"{{'text': {c}, 'cls': {cls}, 'warnings': CASE WHEN ({cls}) = 'warned' THEN {warn} ELSE 0 END}}"


DIRECTIVES_SQL = f"""
WITH c AS ({COMMANDS_SQL}),
cm0 AS (SELECT *, {cell_marker_sql()} AS cell_m FROM c),
lc AS (SELECT *, {comments_sql()} AS comments FROM cm0),
cl AS (SELECT *, list_transform(comments, lambda x: {classify_sql('x')}) AS classified FROM lc),
d AS (SELECT *, list_transform(list_filter(classified, lambda x: x.cls = 'directive'), lambda x: x.text) AS directives,
        len(list_filter(classified, lambda x: x.cls = 'double_todo')) AS n_double,
        coalesce(list_sum(list_transform(classified, lambda x: x.warnings)), 0) AS n_warn FROM cl)
SELECT *, len(list_filter(directives, lambda x: x NOT IN {lst(K.HEADER_FOOTER)})) AS n_main FROM d"""


def directive_messages_sql() -> str:
    """message bodies per cell from ``classified``, ``directives`` and ``n_main``."""
    q = chr(39)
    per = ("flatten(list_transform(classified, lambda x: list_filter(["
           "CASE WHEN x.cls = 'double_todo' THEN 'Found double-comment of TODO directive' END, "
           "CASE WHEN x.cls = 'warned' AND contains(x.text, '-') THEN 'Hyphen found in directive \"' || x.text || '\": ' || x.text END, "
           f"CASE WHEN x.cls = 'warned' AND x.text NOT IN {lst(K.SUPPORTED_DIRECTIVES)} THEN "
           "'Unsupported directive \"' || x.text || '\", see the publishing help for more information.' END], "
           "lambda m: m IS NOT NULL)))")
    open_b = q + "): [" + q * 3            # SQL literal for the text  ): ['
    sep = q * 3 + ", " + q * 3             # SQL literal for the text  ', '
    close = q * 3 + "]" + q                # SQL literal for the text  ']
    multiple = (f"CASE WHEN n_main > 1 THEN ['Found multiple directives (' || n_main || {open_b} || "
                f"array_to_string(directives, {sep}) || {close}] ELSE [] END")
    return f"list_concat({per}, {multiple})"
