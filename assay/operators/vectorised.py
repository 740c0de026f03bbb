"""A caller's vectorised checks: Python functions of whole column batches.

Each task runs all functions over its batches and keeps, for each check, counts
that add up: rows, rows that failed, batches that raised.  These partial states
are all that leaves a task, and merging them is a sum, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.checks import Check

_PARTIAL = "check_id string, n bigint, failed bigint, raised bigint, error string"


def vector_results(df: DataFrame, checks: dict[str, tuple[Callable, list[str]]]) -> DataFrame:
    """``check_id, n, failed, raised, error, passed``, a row for each of
    ``checks``: id -> (function, columns).  The function takes the columns as
    pandas Series and returns a boolean Series (null: failed) or one boolean for
    the batch.  It passes if no row failed and no batch raised; ``error`` is the
    smallest text of what was raised.  A frame without rows passes.

    One pass over the columns that the checks name, in batches: a function sees
    a batch at a time, never a partition."""
    names = sorted({c for _, cols in checks.values() for c in cols})
    ids = list(checks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = {i: [0, 0, 0, None] for i in ids}
        for pdf in batches:
            for i, (fn, cols) in checks.items():
                s, rows = state[i], len(pdf)
                s[0] += rows
                try:
                    got = fn(*(pdf[c] for c in cols))
                    if isinstance(got, pd.Series):
                        if len(got) != rows:
                            raise ValueError(f"{len(got)} results for {rows} rows")
                        s[1] += rows - int(got.eq(True).fillna(False).sum())
                    else:
                        s[1] += 0 if got is True or (got is not None and bool(got)) else rows
                except Exception as e:  # noqa: BLE001 - every failure becomes data
                    s[2] += 1
                    told = f"{type(e).__name__}: {e}"
                    s[3] = told if s[3] is None else min(s[3], told)
        yield pd.DataFrame([(i, *s) for i, s in state.items()], columns=["check_id", "n", "failed", "raised", "error"])

    # A frame without columns still has its rows counted.
    given = df.select(*[f"`{c}`" for c in names]) if names else df.select(F.lit(1).alias("_one"))
    total = given.mapInPandas(run, _PARTIAL).groupBy("check_id").agg(
        F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.sum("raised").alias("raised"), F.min("error").alias("error"))
    return total.withColumn("passed", (F.col("failed") == 0) & (F.col("raised") == 0))


def check_vectorised(check_id: str, df: DataFrame, fn: Callable, columns: list[str], description: str | None = None, **kw) -> Check:
    """A check of a suite by a caller's function: ``[[ACTUAL_VALUE]]`` of its
    hint is the number of rows that failed, or the text of what was raised."""
    one = vector_results(df, {check_id: (fn, columns)})
    shown = F.max(F.coalesce("error", F.col("failed").cast("string")))
    return Check(check_id, description or f"{check_id} holds", F.coalesce(one.agg(F.every("passed")).scalar(), F.lit(True)),
                 actual=one.agg(shown).scalar(), scalar=True, **kw)
