"""Connected components of a links table as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: for every node of a link, the smallest node that it is
    connected with.  Each round first hooks a node's larger neighbours and then
    its smaller ones to its smallest neighbour, until every component is a star;
    the number of rounds grows with the logarithm of the longest path.  Every
    round is a written table of at most as many rows as there are links.
    """
    edges = stage(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
        if state == seen:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                edges.select("lo", "lo").distinct())
        seen = state
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(least.select("hi", F.col("m"))).distinct())
        edges = stage(small, "edges")
