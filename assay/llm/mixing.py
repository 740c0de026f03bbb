"""Mixing sources to target weights by weighted fair queueing, in DataFrame
functions only.

Every source is a queue of its documents in a shuffled order that depends on
ids alone.  A document that may be taken several times stands in the queue once
per pass, one whole pass after the other.  Its virtual finish time is the
number of words its queue has handed out with it, divided by the target of the
source: at time 1 every queue has handed out its target.  Taking documents by
finish time therefore keeps all sources in step, and the total budget ends it.

No queue and no order goes through one task: a queue is cut into ranges of its
shuffle key and the time line into ranges of time; only sums for each range are
added up over the whole, running sums inside a range stay there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assay.llm.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5          # of all words
PASSES = 2           # times that a document is taken at most
RANGES = 4096        # ranges of a queue and of the time line
SOURCES = 50_000     # rows of a table with one row for each source that is broadcast; beyond, a join by source and salt
SALTS = 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(source: Column, doc_id: Column) -> Column:
    """128 bits as hexadecimal text; equal on every run."""
    return F.md5(F.concat_ws(":", F.coalesce(source, F.lit("")), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``queue, source_size, target`` from rows with ``queue, source, size``.

    Sources in code-point order, null last, take the weights in turn.  A target
    stops at ``passes`` times the source's size and the excess goes to the
    others by weight.  With the sources ordered by limit / weight, those that
    reach their limit stand first: a source does so if the level at which the
    words left over would be shared out is not below its own ratio.  The frame
    that is sorted as a whole has one row for each source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    whole = W.partitionBy()
    before = W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    src = (sizes.groupBy("queue", "source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
           .withColumn("most", (F.col("source_size") * passes).cast("double"))
           .withColumn("ratio", F.col("most") / F.col("weight"))
           .withColumn("remaining", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
           .withColumn("weights", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", F.col("remaining") / F.col("weights")))
    # Beyond the first source below its limit, whose level is the common one, levels only fall.
    common = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(whole)
    return src.withColumn("common", common).select(
        "queue", "source_size",
        F.when(F.col("level") < F.col("ratio"), F.col("common") * F.col("weight")).otherwise(F.col("most")).alias("target"))


def queued(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> list[Column]:
    """``queue`` (the source, never null), ``key`` (its shuffle key) and
    ``size`` of a row of ``docs``."""
    return [F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("queue"),
            shuffle_key(F.col(source), F.col(doc_id)).alias("key"), size_of(F.col(text)).alias("size")]


def with_source(rows: DataFrame, known: DataFrame, salt: str = "key") -> DataFrame:
    """``rows`` with the columns of ``known``, which has one row for each
    ``queue``.  No task gets all rows of a source."""
    if known.limit(SOURCES + 1).count() <= SOURCES:
        return rows.join(F.broadcast(known), "queue")
    spread = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.hash(salt), F.lit(SALTS))).join(spread, ["queue", "_salt"]).drop("_salt")


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row for each source: ``queue, source_size, target, upto``.  The mix
    takes a row in pass ``p`` if its key is not above ``upto[p]`` (null: none).

    ``sizes``: a written table with ``queue, source, key, size``.
    """
    goal = stage(targets(sizes, weights, share, passes), "targets")
    spot = F.conv(F.substring("key", 1, 3), 16, 10).cast("int").alias("spot")     # 4096 ranges of a queue
    ranged = sizes.select("queue", "key", "size", spot)
    # Sums for each range, added up along the queue; then running sums inside a range.
    offsets = ranged.groupBy("queue", "spot").agg(F.sum("size").alias("words")).select(
        "queue", "spot", F.coalesce(F.sum("words").over(
            W.partitionBy("queue").orderBy("spot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    running = F.sum("size").over(W.partitionBy("queue", "spot").orderBy("key"))   # rows of one key have one sum
    line = ranged.withColumn("running", running).join(offsets, ["queue", "spot"])
    line = (with_source(line, goal)
            .select("queue", "key", "size", "source_size", "target", (F.col("before") + F.col("running")).alias("handed")))
    # Every pass has its own finish time; a source is never taken beyond twice its target.
    timed = (line.withColumn("nth", F.explode(F.array(*[F.lit(p) for p in range(passes)])))
             .withColumn("finish", F.try_divide(F.col("handed") + F.col("nth") * F.col("source_size"), F.col("target")))
             .where("finish <= 2").withColumn("moment", F.floor(F.col("finish") * (RANGES // 2))))
    timed = stage(timed.select("queue", "key", "size", "nth", "finish", "moment"), "timed")
    budget = goal.agg(F.sum("target").alias("budget"))
    moments = (timed.groupBy("moment").agg(F.sum("size").alias("words"))
               .select("moment", F.coalesce(F.sum("words").over(W.orderBy("moment").rowsBetween(W.unboundedPreceding, -1)),
                                            F.lit(0)).alias("before")))
    running = F.sum("size").over(W.partitionBy("moment").orderBy("finish", "queue", "nth", "key"))
    spent = timed.withColumn("running", running).join(moments, "moment").withColumn("spent", F.col("before") + F.col("running"))
    taken = spent.where(F.col("spent") <= F.lit(budget.first()["budget"] or 0.0))      # one number
    upto = taken.groupBy("queue").agg(*[F.max(F.when(F.col("nth") == p, F.col("key"))).alias(f"_{p}") for p in range(passes)])
    return goal.join(upto, "queue", "left").select(
        "queue", "source_size", "target", F.array(*[F.col(f"_{p}") for p in range(passes)]).alias("upto"))


def _times() -> Column:
    return F.size(F.filter("upto", lambda u: F.coalesce(F.col("key") <= u, F.lit(False))))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, size, source_size, target,
    taken, times``.

    A null text has size 0; a null source is a source of its own and takes its
    weight last.  The shuffle key depends on source and id alone, so reruns
    agree; rows that share both, as those of a source without ids, are taken or
    left together.  An empty table, or one without words, has targets of 0 and
    nothing taken.  Other columns play no part.
    """
    sizes = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                              *queued(docs, doc_id, text, source)), "sizes")
    return (with_source(sizes, stage(plan(sizes, weights, share, passes), "plan")).withColumn("times", _times())
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.

    Null ids, texts and sources as in :func:`mix_plan`; repeated rows are rows of
    their own.  Up to ``SOURCES`` sources the plan, one row for each, is broadcast
    and texts are not shuffled.  Columns keep their names and order.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sizes = stage(docs.select(F.col(source).alias("source"), *queued(docs, doc_id, text, source)), "sizes")
    how = stage(plan(sizes, weights, share, passes), "plan")
    queue, key, _ = queued(docs, doc_id, text, source)
    rows = with_source(docs.select(F.struct(*columns).alias("doc"), queue, key), how)
    return rows.select("doc", F.explode(F.array_repeat(F.lit(True), _times()))).select("doc.*")
