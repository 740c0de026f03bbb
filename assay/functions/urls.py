"""Query-string parsing with the reference's rules: split on '?', then '&',
and a value is the text between the first and a second '='."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_query(url: Column, default_base: str | None = None) -> dict[str, Column]:
    parts = F.split(url, r"\?", -1)
    n = F.size(parts)
    base = F.when(n == 1, F.lit(default_base)).when(n == 2, F.try_element_at(parts, F.lit(1)))
    qs = F.when(n == 1, F.try_element_at(parts, F.lit(1))).when(n == 2, F.try_element_at(parts, F.lit(2)))
    kvs = F.split(qs, "&", -1)
    valid = (n <= 2) & F.forall(kvs, lambda kv: kv.contains("="))
    return {"parts": parts, "base": base, "query": qs, "kvs": kvs, "valid": valid}


def param(kvs: Column, key: str) -> Column:
    """Last occurrence wins (dict semantics); NULL when absent."""
    vals = F.transform(F.filter(kvs, lambda kv: F.split(kv, "=", -1)[0] == key),
                       lambda kv: F.try_element_at(F.split(kv, "=", -1), F.lit(2)))
    return F.try_element_at(vals, F.lit(-1))


def url_has(url: Column, kvs: Column, prefix: str, keys: list[str]) -> Column:
    ok = url.startswith(prefix)
    for k in keys:
        ok = ok & F.exists(kvs, _starts(k + "="))
    return ok


def _starts(prefix: str):
    return lambda kv: kv.startswith(prefix)
