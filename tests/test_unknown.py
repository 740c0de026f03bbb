"""Fields and types of records are found in the data."""

import pytest

from assay.operators import unknown as U


def frame(spark, rows):
    return spark.createDataFrame(rows, "source string, body string")


def test_kinds_paths_and_conflicts(spark):
    rows = [("a", '{"x":1,"y":{"z":[1,"t",null,{"w":true}]}}'), ("a", '{"x":1.5}'), ("a", '{"x":null}'), ("b", '{"x":"1"}'),
            ("b", '{"x":2}'), ("b", "{"), ("b", None), ("c", "[1]"), ("c", "7"), ("c", "{}")]
    got = {(r.source, r.path, r.kind): (r.n, r.n_kinds, r.conflict) for r in U.discovered_fields(frame(spark, rows)).collect()}
    assert got == {
        ("a", "", "object"): (3, 1, False), ("a", "x", "integer"): (1, 3, False), ("a", "x", "decimal"): (1, 3, False), ("a", "x", "null"): (1, 3, False),
        ("a", "y", "object"): (1, 1, False), ("a", "y.z", "array"): (1, 1, False), ("a", "y.z[]", "integer"): (1, 4, True), ("a", "y.z[]", "text"): (1, 4, True),
        ("a", "y.z[]", "null"): (1, 4, True), ("a", "y.z[]", "object"): (1, 4, True), ("a", "y.z[].w", "boolean"): (1, 1, False),
        ("b", "", "object"): (2, 3, True), ("b", "", "unparsable"): (1, 3, True), ("b", "", "missing"): (1, 3, True),
        ("b", "x", "text"): (1, 2, True), ("b", "x", "integer"): (1, 2, True),
        ("c", "", "array"): (1, 3, True), ("c", "", "integer"): (1, 3, True), ("c", "", "object"): (1, 3, True), ("c", "[]", "integer"): (1, 1, False)}


def test_union_takes_types_from_the_data(spark):
    rows = [("a", '{"n":1,"m":1,"it\'s":"q","flag":true,"deep":{"k":[1]}}'), ("b", '{"n":2.5,"m":"x","gone":null}'), ("b", None), ("b", "{")]
    t = U.union_unknown(frame(spark, rows))
    assert dict(t.dtypes) == {"source": "string", "deep": "string", "flag": "boolean", "it's": "string", "m": "string", "n": "double"}
    got = sorted((tuple(r) for r in t.select("source", "deep", "flag", "it's", "m", "n").collect()), key=repr)
    assert got == sorted([("a", '{"k":[1]}', True, "q", "1", 1.0), ("b", None, None, None, "x", 2.5), ("b", *[None] * 5), ("b", *[None] * 5)], key=repr)
    with pytest.raises(ValueError):
        U.union_unknown(frame(spark, rows), most=2)


def test_no_records(spark):
    none = frame(spark, [])
    assert U.discovered_fields(none).count() == 0 and U.union_unknown(none).columns == ["source"]


def test_schema_of_each_source(spark):
    got = {r.source: r.schema for r in U.schema_text(frame(spark, [("a", '{"x":1}'), ("a", '{"y":"t"}'), ("b", '{"x":1}'), ("b", '{"x":"t"}')])).collect()}
    assert got == {"a": "OBJECT<x: BIGINT, y: STRING>", "b": "OBJECT<x: VARIANT>"}
