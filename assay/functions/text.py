"""Text Column builders: escaping, whitespace, templates, URL pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Whitespace as Python's str.strip() sees it: Java's \s misses NBSP and the
# other Unicode space separators, so \p{Z} is added.
WS = r"[\s\p{Z}]"


def py_strip(value) -> Column:
    return F.regexp_replace(_c(value), rf"^{WS}+|{WS}+$", "")


def tail(value, start) -> Column:
    """The text from position ``start`` (1-based) to its end."""
    v = _c(value)
    return F.substring(v, start, F.length(v))


def left_pad(value, width: int, pad: str = " ") -> Column:
    """Padded on the left to ``width``; longer text stays whole (``lpad`` cuts it)."""
    v = _c(value)
    return F.when(F.length(v) < width, F.lpad(v, width, pad)).otherwise(v)


def html_escape(value) -> Column:
    """``html.escape(quote=True)``: & < > " '."""
    v = F.replace(_c(value), F.lit("&"), F.lit("&amp;"))
    v = F.replace(v, F.lit("<"), F.lit("&lt;"))
    v = F.replace(v, F.lit(">"), F.lit("&gt;"))
    v = F.replace(v, F.lit('"'), F.lit("&quot;"))
    return F.replace(v, F.lit("'"), F.lit("&#x27;"))


def chat_escape(value) -> Column:
    """Only & < > (chat control characters)."""
    v = F.replace(_c(value), F.lit("&"), F.lit("&amp;"))
    v = F.replace(v, F.lit("<"), F.lit("&lt;"))
    return F.replace(v, F.lit(">"), F.lit("&gt;"))


def url_quote(value) -> Column:
    """Percent-encoding with nothing but ``A-Za-z0-9_.-~`` kept.

    ``url_encode`` is form-style (space -> '+', keeps '*', encodes '~'); the
    three differences are patched (a literal '+' is already '%2B').
    """
    v = F.url_encode(_c(value))
    v = F.replace(v, F.lit("+"), F.lit("%20"))
    v = F.replace(v, F.lit("*"), F.lit("%2A"))
    return F.replace(v, F.lit("%7E"), F.lit("~"))


def render_template(text, params: dict[str, str]) -> Column:
    """Replace ``{{key}}`` by value for every entry of a small literal map."""
    v = _c(text)
    for k, val in params.items():
        v = F.replace(v, F.lit("{{" + k + "}}"), F.lit(str(val)))
    return v


def render_template_map(text, mapping) -> Column:
    """Same as :func:`render_template` with a per-row MAP<string,string> column."""
    return F.aggregate(F.map_entries(_c(mapping)), _c(text),
                       lambda acc, e: F.replace(acc, F.concat(F.lit("{{"), e["key"], F.lit("}}")), e["value"]))


def residual_mustaches(text) -> Column:
    """Placeholders still present after rendering."""
    return F.regexp_extract_all(_c(text), F.lit(r"\{\{[^{}]*\}\}"), 0)


def path_name(path) -> Column:
    """Last '/' component."""
    return F.element_at(F.split(_c(path), "/"), -1)


def path_dir(path, offset: int = -1) -> Column:
    """'/'.join(parts[:offset])."""
    parts = F.split(_c(path), "/")
    n = F.size(parts) + F.lit(offset) if offset < 0 else F.least(F.size(parts), F.lit(offset))
    return F.array_join(F.slice(parts, 1, F.greatest(n, F.lit(0))), "/")


def second_last_part(path) -> Column:
    """``url.split('/')[-2]`` (document id of an edit URL)."""
    return F.element_at(F.split(_c(path), "/"), -2)
