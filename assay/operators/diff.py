"""Frame, row, schema, snapshot, tree and spec comparison as distributed plans.

Nothing is collected: each diff is one shuffle (a signed group-by, by key or by
whole row, for frames; a full outer join on the key for snapshots and trees)
and returns the differences as rows.  Wide values are compared through digests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NumericType, StructType

from assay.functions.text import left_pad
from assay.operators.ordering import with_row_index


# ---- whole frames ---------------------------------------------------------------

def _has_map(t) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def comparable(c: Column, t) -> Column:
    """A form of ``c`` that ``<=>`` accepts: maps become their entries sorted
    by key (so key order does not matter, as for Python dicts), recursively."""
    if not _has_map(t):
        return c
    if isinstance(t, MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            comparable(e["key"], t.keyType).alias("key"), comparable(e["value"], t.valueType).alias("value"))))
    if isinstance(t, ArrayType):
        return F.transform(c, lambda x: comparable(x, t.elementType))
    return F.struct(*[comparable(c[f.name], f.dataType).alias(f.name) for f in t.fields])


def _comparable_frames(a: DataFrame, b: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with ``cols`` as values that compare alike: maps as sorted
    entries, numbers of two types as their common type; values of two kinds
    (text and number, say) never compare equal."""
    ta, tb = ({f.name: f.dataType for f in x.schema.fields} for x in (a, b))

    def value(c: str, own, other) -> Column:
        v = comparable(F.col(f"`{c}`"), own)
        if own == other:
            return v
        if isinstance(own, NumericType) and isinstance(other, NumericType):
            common = a.select(f"`{c}`").unionByName(b.select(f"`{c}`")).schema[c].dataType
            return v.cast(common)
        return F.when(v.isNotNull(), F.concat(F.lit(own.simpleString() + ":"), v.cast("string")))

    return (a.select(*[value(c, ta[c], tb[c]).alias(c) for c in cols]),
            b.select(*[value(c, tb[c], ta[c]).alias(c) for c in cols]))


def _columns(a: DataFrame, b: DataFrame) -> tuple[list[str], list[tuple[str, str]]]:
    """Columns of both frames, and (column, side) of those that only one has."""
    return ([c for c in a.columns if c in b.columns],
            [(c, "left_only") for c in a.columns if c not in b.columns] + [(c, "right_only") for c in b.columns if c not in a.columns])


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs: ``side`` (left_only / right_only) and
    ``n`` (how many more copies that side has).  Order-insensitive; map-side
    partial aggregation collapses duplicates before the shuffle.

    Frames with different columns have no row in common: all rows differ, and
    for each column of one side only there is a row of nulls whose ``side`` is
    ``<side> column <name>``, so that empty frames differ as well."""
    both, alone = _columns(a, b)
    cols = both + [c for c, _ in alone]
    sided = [F.lit(side).alias("_f") for side in (("a", "b") if alone else ("", ""))]
    u = a.select(*a.columns, sided[0], F.lit(1).alias("_s")).unionByName(
        b.select(*b.columns, sided[1], F.lit(-1).alias("_s")), allowMissingColumns=True)
    g = u.groupBy(*cols, "_f").agg(F.sum("_s").alias("_d")).where(F.col("_d") != 0)
    out = g.select(*cols, F.when(F.col("_d") > 0, "left_only").otherwise("right_only").alias("side"),
                   F.abs(F.col("_d")).cast("bigint").alias("n"))
    if alone:
        names = F.explode(F.array(*[F.lit(f"{side} column {c}") for c, side in alone]))
        kinds = {f.name: f.dataType for f in out.schema.fields}
        out = out.unionByName(a.sparkSession.range(1).select(
            *[F.lit(None).cast(kinds[c]).alias(c) for c in cols], names.alias("side"), F.lit(1).cast("bigint").alias("n")))
    return out


def _grouped(a: DataFrame, b: DataFrame, keys: list[str], vals: list[str]) -> DataFrame:
    """Per key (null keys are equal): rows on each side, and for each column
    and the whole row whether its values differ as a multiset.

    One aggregate over the union of both frames; what crosses the shuffle is a
    key, two counts and a signed sum of 64-bit digests for each column, after
    map-side combine, so neither null nor repeated keys go to a join."""
    missing = [k for k in keys if k not in a.columns or k not in b.columns]
    if missing:
        raise ValueError(f"key columns must be in both frames: {missing}")
    ca, cb = _comparable_frames(a, b, keys + vals)

    def side(df: DataFrame, sign: int) -> DataFrame:
        digest = lambda *c: (F.xxhash64(*[F.col(f"`{x}`") for x in c]) * F.lit(sign).cast("decimal(1,0)"))
        return df.select(*[f"`{k}`" for k in keys], F.lit(int(sign > 0)).alias("_a"), F.lit(int(sign < 0)).alias("_b"),
                         *[digest(c).alias(f"_d_{c}") for c in vals],
                         (digest(*vals) if vals else F.lit(sign).cast("decimal(20,0)")).alias("_row"))

    u = side(ca, 1).unionByName(side(cb, -1))
    g = u.groupBy(*[f"`{k}`" for k in keys]).agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"), F.sum("_row").alias("_row"),
        *[F.sum(f"`_d_{c}`").alias(f"_d_{c}") for c in vals])
    return g.withColumn("_same", (F.col("_a") == F.col("_b")) & (F.col("_row") == 0))


def keyed_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the presence (``kind``: left_only, right_only, changed) and the
    names of the columns whose values differ (null-safe).

    Keys may be null, null equalling null, and may repeat: the rows of a key are
    compared as a multiset.  A column that only one frame has is reported by a
    row of null keys, of kind ``column_left_only`` or ``column_right_only``."""
    both, alone = _columns(a, b)
    vals = [c for c in both if c not in keys]
    g = _grouped(a, b, keys, vals)
    diffs = F.array_compact(F.array(*[F.when(F.col(f"`_d_{c}`") != 0, F.lit(c)) for c in vals])) if vals else F.array()
    kind = (F.when(F.col("_b") == 0, "left_only").when(F.col("_a") == 0, "right_only").when(~F.col("_same"), "changed"))
    out = g.select(*[f"`{k}`" for k in keys], kind.alias("kind"),
                   F.when((F.col("_a") > 0) & (F.col("_b") > 0), F.array_join(diffs, ",")).alias("changed_columns")
                   ).where(F.col("kind").isNotNull())
    if alone:
        kinds = {f.name: f.dataType for f in out.schema.fields}
        found = F.inline(F.array(*[F.struct(F.lit(f"column_{side}").alias("kind"), F.lit(c).alias("changed_columns")) for c, side in alone]))
        out = out.unionByName(a.sparkSession.range(1).select(*[F.lit(None).cast(kinds[k]).alias(k) for k in keys], found))
    return out


def ordered_diff(a: DataFrame, b: DataFrame, order: list[str]) -> DataFrame:
    """Positional compare (the reference's ``zipWithIndex`` semantics) on the
    caller's order: rows at the same index must be equal.  Only the order keys
    and a digest of each column are numbered and pinned, not whole rows."""
    both, alone = _columns(a, b)
    ca, cb = _comparable_frames(a, b, both)

    def numbered(df: DataFrame, compared: DataFrame) -> DataFrame:
        wide = compared.select(*[F.xxhash64(f"`{c}`").alias(f"_v_{c}") for c in both], *[F.col(f"`{k}`").alias(f"_k_{k}") for k in order])
        idx = with_row_index(wide, [f"_k_{k}" for k in order], "row_idx")
        return idx.select("row_idx", *[F.col(f"`_v_{c}`").alias(c) for c in both])

    missing = [k for k in order if k not in both]
    if missing:
        raise ValueError(f"order columns must be in both frames: {missing}")
    one_sided = [F.lit(None).cast("bigint").alias(c) for c, side in alone if side == "left_only"]
    other = [F.lit(None).cast("bigint").alias(c) for c, side in alone if side == "right_only"]
    return keyed_diff(numbered(a, ca).select("*", *one_sided), numbered(b, cb).select("*", *other), ["row_idx"])


def rows_equal(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: are the rows equal as name-keyed dicts (column order ignored,
    None == None; a missing row or a missing column is unequal; repeated keys
    are compared as multisets)."""
    both, alone = _columns(a, b)
    g = _grouped(a, b, keys, [c for c in both if c not in keys])
    return g.select(*[f"`{k}`" for k in keys], (F.col("_same") & F.lit(not alone)).alias("rows_equal"))


def frame_summary(diff: DataFrame) -> DataFrame:
    """One-row verdict over a diff result (empty diff = equal, also for two
    empty frames)."""
    return diff.agg(F.count(F.lit(1)).alias("n_differences")).withColumn(
        "equal", F.col("n_differences") == 0)


# ---- schemas --------------------------------------------------------------------

def schema_table(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """The schema of ``df`` as rows (table, name, type, nullable, pos); type is
    the Spark class name.  Built from metadata only (no data read)."""
    rows = [(table, f.name, type(f.dataType).__name__, f.nullable, i + 1, f.dataType.simpleString())
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table string, name string, type string, nullable boolean, pos int, "
                                       "type_string string")


def schema_compare(sa: DataFrame, sb: DataFrame, test_column_order: bool = False) -> DataFrame:
    """Full outer of two schema tables on name; nullability ignored."""
    a = sa.select("name", F.col("type_string").alias("type_a"), F.col("pos").alias("pos_a"))
    b = sb.select("name", F.col("type_string").alias("type_b"), F.col("pos").alias("pos_b"))
    j = a.join(b, "name", "full_outer")
    same_type = F.col("type_a").eqNullSafe(F.col("type_b"))
    ok = same_type & (F.lit(not test_column_order) | F.col("pos_a").eqNullSafe(F.col("pos_b")))
    kind = (F.when(F.col("type_b").isNull(), "only_a").when(F.col("type_a").isNull(), "only_b")
            .when(~same_type, "type").when(~ok, "position").otherwise("same"))
    return j.select("name", "type_a", "type_b", "pos_a", "pos_b", kind.alias("kind"), ok.alias("matches"))


def castable(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Whether the rows of ``df`` fit other types: ``name, type_a, type_b, n,
    n_bad, n_lossy, fits`` for each column of ``types`` that ``df`` has.  A value
    is bad if it has no value of the type, lossy if casting back gives another;
    null fits every type.  One aggregate over the named columns."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = [c for c in types if c in kinds]
    aggs = []
    for i, c in enumerate(names):
        x, y = F.col(f"`{c}`"), F.col(f"`{c}`").try_cast(types[c])
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x.isNotNull() & y.isNull()).alias(f"b{i}"),
                 F.count_if(y.isNotNull() & ~x.eqNullSafe(y.try_cast(kinds[c]))).alias(f"l{i}")]
    rows = [F.struct(F.lit(c).alias("name"), F.lit(kinds[c]).alias("type_a"), F.lit(types[c]).alias("type_b"), F.col(f"n{i}").alias("n"),
                     F.col(f"b{i}").alias("n_bad"), F.col(f"l{i}").alias("n_lossy"), (F.col(f"b{i}") == 0).alias("fits")) for i, c in enumerate(names)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


# ---- snapshots and trees --------------------------------------------------------

def digest(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.sha2(F.col(text), 256).alias("_h"), F.length(text).alias("_len"))


def _thousands(c: Column) -> Column:
    return F.format_string("%,d", c)


def snapshot_diff(a: DataFrame, b: DataFrame, key: str = "path", text: str = "contents") -> DataFrame:
    """Deleted / added / differs by path; contents compared by SHA-256 and
    only digests and lengths cross the shuffle."""
    da = digest(a, key, text).withColumnsRenamed({"_h": "_ha", "_len": "len_a"})
    db = digest(b, key, text).withColumnsRenamed({"_h": "_hb", "_len": "len_b"})
    j = da.join(db, key, "full_outer")
    label = F.concat(_thousands(F.col("len_a")), F.lit(" vs "), _thousands(F.col("len_b")), F.lit(":"))
    label = left_pad(label, 20)
    kind = (F.when(F.col("_hb").isNull(), "deleted").when(F.col("_ha").isNull(), "added")
            .when(F.col("_ha") != F.col("_hb"), "differs"))
    msg = (F.when(kind == "deleted", F.concat(F.lit("Notebook deleted: `"), F.col(key), F.lit("`")))
           .when(kind == "added", F.concat(F.lit("Notebook added: `"), F.col(key), F.lit("`")))
           .otherwise(F.concat(F.lit("Differences: "), label, F.lit(" "), F.col(key))))
    return (j.select(key, kind.alias("kind"), "len_a", "len_b", msg.alias("message"))
            .where(F.col("kind").isNotNull()))


def tree_compare(src: DataFrame, dst: DataFrame, key: str = "path",
                 attrs: tuple[str, ...] = ("object_type", "language")) -> DataFrame:
    """Entries present on one side only, or present on both with a different
    type or language.  A full outer join, so nothing is lost at the end of
    either listing."""
    s = src.select(key, *[F.col(x).alias(f"s_{x}") for x in attrs], F.lit(True).alias("_in_s"))
    t = dst.select(key, *[F.col(x).alias(f"t_{x}") for x in attrs], F.lit(True).alias("_in_t"))
    j = s.join(t, key, "full_outer")
    differ = reduce(lambda x, y: x | y, [~F.col(f"s_{x}").eqNullSafe(F.col(f"t_{x}")) for x in attrs])
    kind = (F.when(F.col("_in_t").isNull(), "source_only").when(F.col("_in_s").isNull(), "target_only")
            .when(differ, "mismatch"))
    return (j.select(key, kind.alias("kind"), *[f"s_{x}" for x in attrs], *[f"t_{x}" for x in attrs])
            .where(F.col("kind").isNotNull()))


# ---- spec drift -----------------------------------------------------------------

def spec_drift(records: DataFrame, spec: dict, id_cols: list[str],
               exclusive: list[tuple[str, str]] = ()) -> DataFrame:
    """Per record, ``k=v`` for every spec key the record lacks or differs on
    (spec key order), joined with ', '.  The spec is a small literal, so this
    is a per-row projection: no join and no shuffle.

    ``exclusive`` pairs (a, b): when the spec sets ``a`` and the record has a
    non-null ``b``, ``b`` is reported as a difference too.
    """
    present = set(records.columns)
    parts = []
    for k, v in spec.items():
        if k not in present:
            parts.append(F.lit(f"{k}=None"))
            continue
        actual = F.col(k)
        differs = ~actual.eqNullSafe(F.lit(v))
        shown = F.coalesce(actual.cast("string"), F.lit("None"))
        parts.append(F.when(differs, F.concat(F.lit(f"{k}="), shown)))
    for a, b in exclusive:
        if a in spec and b in present:
            parts.append(F.when(F.col(b).isNotNull(), F.concat(F.lit(f"{b}="), F.col(b).cast("string"))))
    err = F.array_join(F.array_compact(F.array(*parts)), ", ")
    return (records.select(*id_cols, err.alias("error")).where(F.col("error") != ""))


def policy_audit(policies: DataFrame, name: str, definition: str, acl: str, expected_pool: str,
                 exempt_type: str = "dlt", group: str = "users", level: str = "CAN_USE",
                 acl_prefix: str = "Student") -> DataFrame:
    """Policies whose JSON definition names another pool than ``expected_pool``
    (unless of the exempt cluster type), and policies named ``acl_prefix...``
    whose ACL lacks ``level`` for ``group`` (first permission of the entry)."""
    ctype = F.get_json_object(definition, "$.cluster_type.value")
    pool = F.get_json_object(definition, "$.instance_pool_id.value")
    wrong = ~ctype.eqNullSafe(F.lit(exempt_type)) & ~pool.eqNullSafe(F.lit(expected_pool))
    # Entries of users have no group, and a policy may have no entries: neither is access.
    has_use = F.coalesce(F.exists(acl, lambda a: a["group_name"].eqNullSafe(F.lit(group)) & F.try_element_at(
        a["all_permissions"], F.lit(1))["permission_level"].eqNullSafe(F.lit(level))), F.lit(False))
    errors = F.array_compact(F.array(F.when(wrong, F.lit("Wrong instance pool")), F.when(
        F.col(name).startswith(acl_prefix) & ~has_use, F.lit(f"Missing {group} access"))))
    return policies.select(F.col(name).alias("policy"), F.explode_outer(errors).alias("error")).where("error is not null")
