"""Records of unknown schema: which fields there are, and a table of them.

Bodies are JSON texts, parsed to VARIANT.  The fields are found from the data,
level by level: each level explodes the objects and arrays of the one above and
counts kinds by path, with partial sums, so that only paths and kinds move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.session import checkpoint_dir

#: Kinds by the start of the type name that Spark gives a value.
KINDS = {"OBJECT": "object", "ARRAY": "array", "BIGINT": "integer", "DECIMAL": "decimal", "DOUBLE": "decimal", "FLOAT": "decimal",
         "STRING": "text", "BOOLEAN": "boolean", "VOID": "null"}
#: Column types of a field by its kinds, null left out; others are text.
TYPES = {("integer",): "bigint", ("decimal",): "double", ("decimal", "integer"): "double", ("boolean",): "boolean"}


def kind_of(value: Column) -> Column:
    name = F.schema_of_variant(value)
    return reduce(lambda c, k: c.when(name.startswith(k), KINDS[k]), list(KINDS)[1:], F.when(name.startswith("OBJECT"), "object")).otherwise(F.lower(name))


def found_kinds(records: DataFrame, source: str, body: str) -> DataFrame:
    """``source, path, kind, n``: how often a value of each kind stands at each
    path; '' is the body itself, 'a.b' a field, 'a[]' the elements of a list.  A
    body that is no JSON has the kind 'unparsable', a null one 'missing'."""
    checkpoint_dir(records.sparkSession)
    text = records.select(F.col(source).alias("source"), F.col(body).alias("_t"), F.try_parse_json(body).alias("v"))
    kind = F.when(F.col("_t").isNull(), "missing").when(F.col("v").isNull(), "unparsable").otherwise(kind_of(F.col("v")))
    level = text.select("source", F.lit("").alias("path"), "v", kind.alias("kind"))
    found = []
    while True:
        counts = level.groupBy("source", "path", "kind").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
        found.append(counts)
        if counts.where(F.col("kind").isin("object", "array")).isEmpty():
            return reduce(DataFrame.union, found)
        level = level.where(F.col("kind").isin("object", "array")).lateralJoin(
            records.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("key"), F.col("value")))
        name = F.when(F.col("kind") == "array", F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("key")).otherwise(
            F.concat_ws(".", "path", "key"))
        level = level.select("source", name.alias("path"), F.col("value").alias("v")).withColumn("kind", kind_of(F.col("v")))


def discovered_fields(records: DataFrame, source: str = "source", body: str = "body") -> DataFrame:
    """``source, path, kind, n, n_kinds, conflict``, a row for each kind found
    at a path; ``conflict``: values of several kinds stand there, null and
    integers among decimals not counted."""
    kinds = found_kinds(records, source, body)
    real = F.when(F.col("kind") == "integer", "decimal").when(F.col("kind") != "null", F.col("kind"))
    per = kinds.groupBy("source", "path").agg(F.count("*").alias("n_kinds"), (F.count_distinct(real) > 1).alias("conflict"))
    return kinds.join(per, ["source", "path"]).select("source", "path", "kind", "n", "n_kinds", "conflict")


def schema_text(records: DataFrame, source: str = "source", body: str = "body") -> DataFrame:
    """``source, schema``: the type that holds all bodies of each source, VARIANT where they conflict."""
    return (records.select(F.col(source).alias("source"), F.try_parse_json(body).alias("v"))
            .groupBy("source").agg(F.schema_of_variant_agg("v").alias("schema")))


def union_unknown(records: DataFrame, source: str = "source", body: str = "body", most: int = 2000) -> DataFrame:
    """One table of all records: ``source`` and a column for each field of any
    body, by name, null where a record lacks it.  A field is a bigint, double or
    boolean where all its values are, else text (JSON for objects and lists).
    Only names and kinds come to the driver; more than ``most`` fields are an
    error, as such bodies are keyed by data.  A field named like ``source``
    (whatever its case) is left to :func:`discovered_fields`."""
    top = found_kinds(records, source, body).where("path <> '' and not contains(path, '.') and not contains(path, '[]')")
    rows = top.where("kind <> 'null'").groupBy("path").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} fields")
    v = records.select(F.col(source).alias("source"), F.try_parse_json(body).alias("v"))
    columns = []
    for path, kinds in sorted((r.path, tuple(r.kinds)) for r in rows):
        if path.lower() != "source" and not {'"', "'"} <= set(path):
            quote = '"' if "'" in path else "'"                    # a path has no escapes
            columns.append(F.try_variant_get("v", f"$[{quote}{path}{quote}]", TYPES.get(kinds, "string")).alias(path))
    return v.select("source", *columns)
