"""Failure propagation over an explicit dependency DAG, by pointer doubling.

Every node that may still turn out either way keeps pointers to what it depends
on.  A round asks which pointers lead to a failed or skipped node; those nodes
are settled.  Every other node then takes over the pointers of the nodes that it
points to, so that a pointer spans twice as many dependencies as before and a
chain of any depth is settled in about log2(depth) rounds.  A node whose pointers
all end at nodes without dependencies loses them and is settled, too.

Where dependencies are braided (many paths between two nodes) doubled pointers
may outgrow the edges.  Their number is worked out before they are made; beyond
``GROWTH`` times the edges the pointers stay as they are and failures go
forward along them, several hops a round.

Each round is written by a reliable ``checkpoint()`` (in ``spark.checkpoint.dir``),
so that an executor loss re-reads files instead of replaying rounds; nothing is
cached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import checkpoint_dir

#: Doubled pointers for each edge; hops of a round that does not double; pointers up to which the growth is not asked for.
GROWTH, HOPS, FEW = 4, 4, 100_000


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def reached(edges: DataFrame, sources: DataFrame, child: str = "child", parent: str = "parent", node: str = "id",
            growth: float = GROWTH) -> tuple[DataFrame | None, int]:
    """Nodes (column ``node``) with a path of ``edges`` to one of ``sources``
    (not the sources themselves), ``None`` for none, and the number of rounds.

    Null ends of an edge lead nowhere; repeated edges and sources, and cycles,
    do no harm.  Pointers into a source are cut: what lies beyond it changes
    nothing for the nodes before it.
    """
    checkpoint_dir(edges.sparkSession)
    start = sources.select(F.col(node).alias("_r")).where("_r is not null").distinct().checkpoint(eager=True)
    if start.isEmpty():
        return None, 0
    # Edges from a source are asked for once, at the end: it is settled already.
    all_edges = edges.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).where("_c is not null and _p is not null")
    pointers = all_edges.where("_c <> _p").join(start, F.col("_c") == F.col("_r"), "left_anti").distinct().checkpoint(eager=True)
    first = pointers.count()
    known, at, rounds, size, doubling = [start], start, 0, first, first > 0
    most = first.bit_length() + 2                       # by then pointers span any path without a cycle
    while size and (rounds < most if doubling else not at.isEmpty()):
        rounds += 1
        if doubling:
            hit = pointers.join(_union(known), F.col("_p") == F.col("_r"), "left_semi").select(F.col("_c").alias("_r")).distinct().checkpoint(eager=True)
            left = pointers.join(hit, F.col("_c") == F.col("_r"), "left_anti")
            known.append(hit)
            if size > FEW:
                fan = pointers.groupBy(F.col("_c").alias("_p")).agg(F.count("*").alias("_n"))
                grown = left.groupBy("_p").agg(F.count("*").alias("_m")).join(fan, "_p").agg(
                    F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
                doubling = grown <= growth * first
            if doubling:
                beyond = pointers.select(F.col("_c").alias("_p"), F.col("_p").alias("_q"))
                pointers = (left.join(beyond, "_p").select("_c", F.col("_q").alias("_p")).where("_c <> _p").distinct().checkpoint(eager=True))
                size = pointers.count()
            else:
                pointers, at = left.checkpoint(eager=True), _union(known)
        else:
            steps = []
            for hop in range(1, HOPS + 1):
                at = pointers.join(at, F.col("_p") == F.col("_r"), "left_semi").select(F.col("_c").alias("_r")).distinct()
                steps.append(at.withColumn("_hop", F.lit(hop)))
            new = _union(steps).groupBy("_r").agg(F.max("_hop").alias("_hop")).join(_union(known), "_r", "left_anti").checkpoint(eager=True)
            known.append(new.select("_r"))
            at = new.where(F.col("_hop") == HOPS).select("_r")      # what an inner hop reached has been followed up
    found = known[1:]
    into = all_edges.join(start, F.col("_c") == F.col("_r"), "left_semi").join(
        _union(known), F.col("_p") == F.col("_r"), "left_semi").select(F.col("_c").alias("_r"))
    return _union([*found, into]).distinct().select(F.col("_r").alias(node)), rounds


def propagate_skips(nodes: DataFrame, edges: DataFrame, node: str = "id", ok: str = "ok",
                    child: str = "child", parent: str = "parent") -> DataFrame:
    """``nodes(node, ok)``, ``edges(child, parent)`` -> ``nodes + status``.

    A node is *skipped* when any node it depends on failed or was skipped,
    otherwise *passed* / *failed* by ``ok`` (null: failed).  Cycles end as well.
    """
    passed = F.coalesce(F.col(ok), F.lit(False))
    skipped, _ = reached(edges, nodes.where(~passed), child, parent, node)
    state = F.when(passed, "passed").otherwise("failed")
    if skipped is None:
        return nodes.withColumn("status", state)
    return (nodes.join(skipped.withColumn("_skipped", F.lit(True)), node, "left")
            .withColumn("status", F.when(F.col("_skipped"), "skipped").otherwise(state)).drop("_skipped"))
