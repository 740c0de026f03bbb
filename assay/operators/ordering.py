"""Order-dependent state without per-key sorts of unbounded groups.

* :func:`cascade_status` -- "after the first failure everything is skipped"
  per suite, as an aggregate (first failing order key per suite, partially
  aggregated map-side) joined back to the rows.  A suite holding a third of
  all rows is handled by AQE's skew-join split of the big side; no window
  sorts a whole suite in one task.
* :func:`with_row_index` -- a distributed ``zipWithIndex``: range-partition on
  the caller's order, number rows inside each partition, and add the
  per-partition offsets (one small row per partition, so a bounded broadcast).
* :func:`batch_of` -- fixed-size batches over that index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assay.session import checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def first_key(df: DataFrame, group: list[str], order: list[str], when: Column, name: str) -> DataFrame:
    """Per group, the smallest ``struct(order)`` among rows where ``when``."""
    return (df.where(when).groupBy(*group)
            .agg(F.min(F.struct(*[F.col(c) for c in order])).alias(name)))


def cascade_status(df: DataFrame, group: list[str], order: list[str], ok: Column,
                   passed: str = "passed", failed: str = "failed", skipped: str = "skipped",
                   status_col: str = "status") -> DataFrame:
    """Linear-chain skip cascade: before the first failure a row keeps its
    own outcome, the first failure is ``failed``, every later row ``skipped``."""
    d = df.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    first = first_key(d, group, order, ~F.col("_ok"), "_first_fail")
    j = d.join(first, group, "left")
    key = F.struct(*[F.col(c) for c in order])
    st = (F.when(F.col("_first_fail").isNull() | (key < F.col("_first_fail")),
                 F.when(F.col("_ok"), F.lit(passed)).otherwise(F.lit(failed)))
          .when(key == F.col("_first_fail"), F.lit(failed))
          .otherwise(F.lit(skipped)))
    return j.withColumn(status_col, st).drop("_first_fail", "_ok")


def with_row_index(df: DataFrame, order: list[str], name: str = "row_idx",
                   num_partitions: int | None = None) -> DataFrame:
    """0-based global row index in ``order`` (keys should be unique so the
    numbering is deterministic when a task is re-run)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_mid", F.monotonically_increasing_id()))
    # the id depends on the physical partitioning, so it is pinned once with a
    # reliable checkpoint; the counts and the numbering then read the same rows
    checkpoint_dir(spark)
    s = s.checkpoint(eager=True)
    s = (s.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
          .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a global window over it is a bounded, tiny sort
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_mid", "_pid", "_local", "_off"))


def batch_of(df: DataFrame, order: list[str], size: int, name: str = "batch") -> DataFrame:
    """Groups of ``size`` consecutive rows in ``order`` (the last may be short)."""
    idx = with_row_index(df, order, "_idx")
    return (idx.withColumn(name, F.floor(F.col("_idx") / F.lit(size)).cast("bigint"))
            .withColumn("pos_in_batch", (F.col("_idx") % size).cast("bigint"))
            .drop("_idx"))
