"""A caller's function over every record, with its failures as data."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_with_errors(df: DataFrame, fn: Callable, args: list[str], result_type: str | T.DataType, keep: list[str],
                      result: str = "result", error: str = "error") -> DataFrame:
    """``keep`` columns, ``result`` = ``fn(*args)`` and ``error``: null, or the
    name and text of the exception that ``fn`` raised for that record, which
    then has a null result and does not fail the job.

    For functions that have no counterpart among the built-in ones; records
    travel to Python in Arrow batches, and only ``keep`` and ``args`` do.
    """
    kinds = {f.name: f for f in df.schema.fields}
    kind = T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    schema = T.StructType([*[kinds[c] for c in keep], T.StructField(result, kind), T.StructField(error, T.StringType())])

    def call(*values):
        try:
            return fn(*values), None
        except Exception as e:  # noqa: BLE001 - every failure becomes data
            return None, f"{type(e).__name__}: {e}"

    def run(batches):
        for pdf in batches:
            made = [call(*values) for values in zip(*(pdf[f"_arg{i}"] for i in range(len(args))))]
            out = {c: pdf[c] for c in keep}
            out[result] = pd.Series([x for x, _ in made], index=pdf.index, dtype=object)
            out[error] = pd.Series([e for _, e in made], index=pdf.index, dtype=object)
            yield pd.DataFrame(out)

    return df.select(*[f"`{c}`" for c in keep], *[F.col(f"`{a}`").alias(f"_arg{i}") for i, a in enumerate(args)]).mapInPandas(run, schema)


def try_with_errors(df: DataFrame, value, failure, keep: list[str], result: str = "result", error: str = "error") -> DataFrame:
    """The same for a built-in expression: ``value`` where ``failure`` (a text
    Column, null for none) is null."""
    return df.select(*keep, F.when(failure.isNull(), value).alias(result), failure.alias(error))


def rows_of_keys(df: DataFrame, make: Callable[[], Callable], key: list[str], order: list[str], args: list[str],
                 result: str | T.StructType, seq: str = "seq", error: str = "error") -> DataFrame:
    """A caller's function that yields any number of rows, over the rows of
    each key: ``key`` columns, ``seq``, the columns of ``result`` and ``error``.

    ``make()`` gives a fresh function for each key, so it may remember what it
    has seen of that key; it is called with ``args`` of one row after another, by
    ``order`` (and ``args``, so that ties have an order, too), and returns an
    iterable of tuples.  An exception becomes a row with its text as ``error`` and
    a null result, after the rows yielded before it; the rows behind it go on.
    ``seq`` numbers the output of a key from 0.

    A table function over a table argument partitioned by key: rows stream
    through it and nothing is collected, but one key is worked off by one task;
    for functions of one row alone use :func:`rows_of_records`, which has no keys.
    """
    kind = T._parse_datatype_string(result) if isinstance(result, str) else result
    kinds = {f.name: f for f in df.schema.fields}
    schema = T.StructType([*[T.StructField(k, kinds[k].dataType) for k in key], T.StructField(seq, T.LongType()), *kind.fields,
                           T.StructField(error, T.StringType())])
    nothing = (None,) * len(kind.fields)
    keys, values = [f"_k{i}" for i in range(len(key))], [f"_a{i}" for i in range(len(args))]

    class Rows:
        def __init__(self):
            self.fn, self.n = None, 0

        def eval(self, row):
            at = tuple(row[k] for k in keys)
            try:
                self.fn = self.fn or make()
                for made in self.fn(*(row[v] for v in values)):
                    yield (*at, self.n, *made, None)
                    self.n += 1
            except Exception as e:  # noqa: BLE001 - every failure becomes data
                yield (*at, self.n, *nothing, f"{type(e).__name__}: {e}")
                self.n += 1

    given = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(key, keys)], *[F.col(f"`{a}`").alias(n) for a, n in zip(args, values)],
                      *[F.col(f"`{o}`").alias(f"_o{i}") for i, o in enumerate(order)])
    by = [f"_o{i}" for i in range(len(order))] + [v for v, a in zip(values, args) if not isinstance(kinds[a].dataType, (T.MapType, T.VariantType))]
    table = given.asTable().partitionBy(*keys)
    return F.udtf(Rows, returnType=schema)(table.orderBy(*by) if by else table)


def rows_of_records(df: DataFrame, fn: Callable, args: list[str], result: str | T.StructType, keep: list[str],
                    seq: str = "seq", error: str = "error") -> DataFrame:
    """The same for a function of one record: ``keep`` columns, ``seq`` within
    the record, the columns of ``result`` and ``error``.  Map-only: a lateral join
    with a table function.  A record that yields nothing has no rows."""
    kind = T._parse_datatype_string(result) if isinstance(result, str) else result
    schema = T.StructType([T.StructField(seq, T.LongType()), *kind.fields, T.StructField(error, T.StringType())])
    nothing = (None,) * len(kind.fields)

    class Rows:
        def eval(self, *values):
            n = 0
            try:
                for made in fn(*values):
                    yield (n, *made, None)
                    n += 1
            except Exception as e:  # noqa: BLE001 - every failure becomes data
                yield (n, *nothing, f"{type(e).__name__}: {e}")

    given = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keep)], *[F.col(f"`{a}`").alias(f"_a{i}") for i, a in enumerate(args)])
    made = given.lateralJoin(F.udtf(Rows, returnType=schema)(*[F.col(f"_a{i}").outer() for i in range(len(args))]))
    return made.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)], *[F.col(f"`{f.name}`") for f in schema.fields])
