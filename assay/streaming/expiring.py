"""Latest result per key as streaming state that forgets silent keys.

The state of a key is its newest row.  A key leaves the state, and the sink
learns so, when the watermark has passed its newest row by more than ``ttl``; if
it speaks again afterwards it starts anew.  So the state holds the keys of the
last ``ttl`` only, however long the stream runs.

The state is a stored table beside the output, a folder for each micro-batch, which
is the one before grouped with the rows that have arrived.  Its newest row is
always there, as it cannot be silent, and the watermark stands a fixed time behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.sources import sinks
from assay.streaming.jobs import event_time


def _ms(us):
    return F.floor(us / 1000)


def _mark(state: DataFrame, watermark: str) -> int | None:
    """The watermark in milliseconds; none before the first row."""
    return state.agg(F.unix_millis(F.timestamp_micros(F.max("_us")) - F.expr(f"interval {watermark}")).alias("t")).first().t


def keep_live(stream: DataFrame, keys: list[str], value: str, ts: str, order: str, ttl_seconds: int, watermark: str,
              out_path: str, checkpoint: str):
    """Take what has arrived.  A micro-batch writes ``keys, at_ms, value, live``
    for every change of a key under its batch id: its newest ``value`` by
    (``ts``, ``order``) with ``live`` true, and false when it expires.  Rows
    without ``ts`` are left out; rows behind the watermark of the batch before come
    too late.  A replay replaces its own files."""
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    inner = [f"_k{i}" for i in range(len(keys))]
    schema = T.StructType([*[T.StructField(n, kinds[k]) for n, k in zip(inner, keys)], T.StructField("_us", T.LongType()),
                           T.StructField("_o", kinds[order]), T.StructField("_v", kinds[value]), T.StructField("_new", T.BooleanType())])
    silent = lambda mark: _ms(F.col("_us")) + ttl_seconds * 1000 < F.lit(mark)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, lambda n: f"{out_path}-state/batch_id={n}"
        rows = batch.where("_us is not null").withColumn("_new", F.lit(True))
        if batch_id:
            before = spark.read.schema(schema).parquet(at(batch_id - 1))
            mark = _mark(before, watermark)
            if mark is not None:
                rows = rows.where(F.col("_us") > mark * 1000).unionByName(before.where(~silent(mark)).withColumn("_new", F.lit(False)))
        newest = F.max_by(F.struct("_us", "_o", "_v", "_new"), F.struct("_us", "_o", ~F.col("_new"))).alias("x")
        rows.groupBy(*inner).agg(newest).select(*inner, "x.*").write.mode("overwrite").parquet(at(batch_id))
        now = spark.read.schema(schema).parquet(at(batch_id))
        live = F.array(F.when(F.col("_new"), F.lit(True)), F.when(silent(_mark(now, watermark)), F.lit(False)))
        told = now.select("*", F.explode(live).alias("live")).where("live is not null")
        told.select(*[F.col(n).alias(k) for n, k in zip(inner, keys)], _ms(F.col("_us")).alias("at_ms"), F.col("_v").alias(value), "live") \
            .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        if batch_id > 1:
            sinks.remove(spark, at(batch_id - 2))

    rows = stream.select(*[F.col(k).alias(n) for n, k in zip(inner, keys)], F.unix_micros(event_time(stream, ts)).alias("_us"),
                         F.col(order).alias("_o"), F.col(value).alias("_v"))
    q = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def changes(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def read_live(spark: SparkSession, out_path: str, keys: list[str], value: str) -> DataFrame:
    """``keys, value`` of the keys that are alive; within a batch a key expires
    after it has spoken."""
    newest = F.max_by(F.struct(value, "live"), F.struct("batch_id", ~F.col("live"))).alias("x")
    return changes(spark, out_path).groupBy(*keys).agg(newest).where("x.live").select(*keys, F.col(f"x.{value}").alias(value))
