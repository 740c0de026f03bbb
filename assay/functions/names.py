"""Naming and hashing Column builders (all Catalyst expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.functions.text import py_strip

# Fixed values that must equal the reference's for identical output:
# the base-36 alphabet of the stable hash, and the name separators.
BASE36_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"
MAX_HASH_LENGTH = 8  # 36^8 * 2^16 stays inside a signed 64-bit value


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_string(value, replacement: str = "_") -> Column:
    """Every char that is not an ASCII letter or a Unicode decimal digit ->
    ``replacement``; runs of the replacement collapse to one."""
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")   # literal in a Java replacement
    v = F.regexp_replace(_c(value).cast("string"), r"[^a-zA-Z\p{Nd}]", rep)
    pat = "(" + "".join("\\" + ch if not ch.isalnum() else ch for ch in replacement) + ")+"
    return F.regexp_replace(v, pat, rep)


def to_build_name(value) -> Column:
    """Course name -> lower-case hyphenated build name (NULL stays NULL)."""
    return F.lower(clean_string(value, "-"))


def to_clean_lesson_name(value) -> Column:
    return clean_string(value, "_")


def file_name_from_title(value, ext: str = ".pdf") -> Column:
    """``name + ext`` with ':' and ' ' -> '-', lower-cased, '-' runs collapsed."""
    v = F.lower(F.translate(F.concat(_c(value), F.lit(ext)), ": ", "--"))
    return F.regexp_replace(v, "-+", "-")


def stable_hash(*args, length: int) -> Column:
    """md5 of the ':'-joined args read as a 128-bit integer, written as
    ``length`` base-36 digits, least significant digit first.

    The 128-bit value is reduced modulo 36^length by Horner's rule over eight
    16-bit chunks of the hex digest, so every step fits a BIGINT.
    """
    if not 1 <= length <= MAX_HASH_LENGTH:
        raise ValueError(f"length must be in 1..{MAX_HASH_LENGTH}")
    m = 36 ** length
    hx = F.md5(F.concat_ws(":", *[_c(a).cast("string") for a in args]))
    r = F.lit(0).cast("bigint")
    for i in range(8):
        chunk = F.conv(F.substring(hx, 4 * i + 1, 4), 16, 10).cast("bigint")
        r = (r * F.lit(65536) + chunk) % F.lit(m)
    # base-36 digits of r (most significant first), padded, then reversed:
    # least significant digit first, as the hash is defined
    return F.reverse(F.lpad(F.lower(F.conv(r.cast("string"), 10, 36)), length, "0"))


def user_hash(username, workspace_id) -> Column:
    """The 4-character per-user hash of ``username + workspace_id``."""
    return stable_hash(F.concat(_c(username), _c(workspace_id).cast("string")), length=4)


def unique_name(username, course_code, workspace_id, lesson_name=None, sep: str = "-", hash_col=None) -> Column:
    """``local-part hash da course [lesson]`` cleaned with ``sep`` and
    lower-cased; pass ``hash_col`` when the hash is already a column."""
    local = F.substring_index(_c(username), "@", 1)
    h = _c(hash_col) if hash_col is not None else user_hash(username, workspace_id)
    parts = [local, h, F.lit("da"), _c(course_code)]
    if lesson_name is not None:
        parts.append(_c(lesson_name))
    return F.lower(clean_string(F.concat_ws(" ", *parts), sep))


def schema_name(username, course_code, workspace_id, lesson_name=None, hash_col=None) -> Column:
    return unique_name(username, course_code, workspace_id, lesson_name, sep="_", hash_col=hash_col)


def catalog_name(username, workspace_id, lesson_name=None, hash_col=None) -> Column:
    """Per-user catalog: ``local-part hash da [lesson]`` cleaned with '_'."""
    local = F.substring_index(_c(username), "@", 1)
    h = _c(hash_col) if hash_col is not None else user_hash(username, workspace_id)
    parts = [local, h, F.lit("da")] + ([_c(lesson_name)] if lesson_name is not None else [])
    return F.lower(clean_string(F.concat_ws(" ", *parts), "_"))


def lesson_number(path) -> Column:
    """Numeric prefix before the first ' - ' (leading non-digits dropped), else
    -1; BIGINT, NULL where a number does not fit it."""
    p = _c(path)
    prefix = py_strip(F.substring_index(p, " - ", 1))
    stripped = F.regexp_replace(prefix, r"^[^\p{Nd}]+", "")
    return (F.when(~p.contains(" - "), F.lit(-1))
            .when(stripped.rlike(r"^[0-9]+$"), stripped.try_cast("bigint"))
            .otherwise(F.lit(-1)).cast("bigint"))


def zero_pad(n, width: int = 3) -> Column:
    return F.format_string(f"%0{width}d", _c(n))
