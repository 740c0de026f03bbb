"""Constraints as metrics of the write itself: a failing batch is set aside.

A micro-batch is written once, under its batch id, and its checks are metrics
observed on that write: no second pass over the batch.  The verdict is a small
file beside the rows, and it is what lets readers in: :func:`passed` reads the
batches whose verdict is good, :func:`quarantine` the others.  A replayed batch
replaces its rows and its verdict; rows without a verdict, of a job that was
lost in between, are read by neither.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def run_gated(stream: DataFrame, checks: Callable[[], dict[str, Column]], out_path: str, checkpoint: str,
              measures: Callable[[], dict[str, Column]] = dict):
    """``checks()``: id -> aggregate boolean over the batch (null: failed);
    ``measures()``: further aggregates that go with the verdict, as text."""
    def write(batch: DataFrame, batch_id: int) -> None:
        wanted, extra = checks(), measures()
        seen = Observation()
        metrics = [F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, c in enumerate(wanted.values())]
        metrics += [c.cast("string").alias(f"m{i}") for i, c in enumerate(extra.values())] + [F.count(F.lit(1)).alias("n")]
        batch.observe(seen, *metrics).write.mode("overwrite").parquet(f"{out_path}/rows/batch_id={batch_id}")
        got = seen.get
        good = all(got[f"c{i}"] for i in range(len(wanted)))
        rows = [(k, bool(got[f"c{i}"]), good, got["n"], {m: got[f"m{j}"] for j, m in enumerate(extra)}) for i, k in enumerate(wanted)]
        batch.sparkSession.createDataFrame(rows, "check_id string, passed boolean, batch_passed boolean, n_rows bigint, measures map<string,string>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{out_path}/verdicts/batch_id={batch_id}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def verdicts(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(f"{out_path}/verdicts")


def _rows(spark: SparkSession, out_path: str, good: bool) -> DataFrame:
    """Rows of the batches of one verdict; only their folders are read."""
    which = verdicts(spark, out_path).where(F.col("batch_passed") == good).select("batch_id").distinct()
    return spark.read.parquet(f"{out_path}/rows").join(F.broadcast(which), "batch_id", "left_semi").drop("batch_id")


def passed(spark: SparkSession, out_path: str) -> DataFrame:
    return _rows(spark, out_path, True)


def quarantine(spark: SparkSession, out_path: str) -> DataFrame:
    return _rows(spark, out_path, False)
