"""Structured Streaming jobs: incremental scorecards and run health.

Each job reads a file stream, keeps its state in the checkpoint folder
``<root>/<query name>`` (one root, a sub-folder per query) and writes through
an idempotent sink, so a restarted query resumes where it stopped and a
re-run micro-batch overwrites its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import checks as C


def checkpoint_location(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def land_files(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Write a table as parquet files of at most ``rows_per_file`` rows, as it is partitioned."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def land_ranges(df: DataFrame, path: str, key: str, width: int) -> None:
    """Write a table as one parquet file for each range of ``width`` keys, in
    one pass; the range is the folder's name."""
    (df.withColumn("_range", F.floor(F.col(key) / width)).repartition("_range")
     .write.mode("overwrite").partitionBy("_range").parquet(path))


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def files_per_trigger(spark: SparkSession, path: str, schema, triggers: int) -> int:
    """How many files a trigger has to take for all that have landed to be
    taken within ``triggers``: every trigger runs all state partitions and
    reports on each, so their number must not follow the table."""
    return max(1, -(-len(spark.read.schema(schema).parquet(path).inputFiles()) // triggers))


def latest_per_key(stream: DataFrame, keys: list[str], value: str, order: list[str], out_path: str,
                   checkpoint: str) -> None:
    """Last value per key (by ``order``) maintained incrementally.  A
    micro-batch writes the keys it has changed under its batch id (a replay
    replaces its own files), so its cost follows the batch, not all keys;
    :func:`read_latest` takes the newest row of each key."""
    agg = stream.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_latest(spark: SparkSession, out_path: str, keys: list[str], value: str) -> DataFrame:
    """The state that :func:`latest_per_key` has written, one row for each key."""
    rows = spark.read.parquet(out_path)
    return rows.groupBy(*keys).agg(F.max_by(value, F.col("batch_id").cast("bigint")).alias(value))


def compact_latest(spark: SparkSession, out_path: str, to_path: str, keys: list[str], value: str) -> None:
    """Write the state as a single batch to another folder; batches that were
    compacted can then be dropped."""
    read_latest(spark, out_path, keys, value).write.mode("overwrite").parquet(f"{to_path}/batch_id=0")


def event_time(df: DataFrame, ts: str):
    """Watermarks need TIMESTAMP: a TIMESTAMP_NTZ column is read as UTC wall
    clock (independent of the session time zone)."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp")
    return F.col(ts)


def utc_wall_clock(c):
    """TIMESTAMP instant -> TIMESTAMP_NTZ holding its UTC wall clock."""
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(secs=F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)))


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], window: str, watermark: str, out_path: str,
                    checkpoint: str):
    """Counts per (tumbling window, keys); closed windows only (append mode
    behind a watermark), written to a parquet sink.  Returns the query for
    its progress (rows dropped as late)."""
    s = stream.withColumn("_t", event_time(stream, ts)).withWatermark("_t", watermark)
    agg = s.groupBy(F.window("_t", window).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    agg = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def rows_dropped_by_watermark(q) -> int:
    """Late rows the windowed aggregation discarded, from the query progress."""
    total = 0
    for p in q.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else getattr(p, "stateOperators", []):
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else getattr(op, "numRowsDroppedByWatermark", 0)
            total += int(v or 0)
    return total


def batch_scorecards(stream: DataFrame, checks_for, out_path: str, checkpoint: str, key: str, width: int) -> None:
    """Run a check suite over every range of ``width`` keys of a micro-batch
    (``checks_for()`` builds the checks); no range may be spread over files.
    Each batch writes ``out_path/batch_id=<n>`` in overwrite mode, so a
    replayed batch replaces its own scorecards."""

    def write(batch: DataFrame, batch_id: int) -> None:
        res = C.run_suite(batch, checks_for(), suite="batch", extra={"batch_first": F.min(key)}, by=F.floor(F.col(key) / width))
        res.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def rolling_counts(stream: DataFrame, ts: str, event_id: list[str], keys: list[str], window: str, slide: str, watermark: str,
                   out_path: str, checkpoint: str):
    """Counts per (sliding window, keys), closed windows only, of events that
    may be replayed: an ``event_id`` that comes again within the watermark of
    its first row is dropped.  Returns the query."""
    s = stream.withColumn("_t", event_time(stream, ts)).withWatermark("_t", watermark).dropDuplicatesWithinWatermark(event_id)
    agg = s.groupBy(F.window("_t", window, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    agg = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
