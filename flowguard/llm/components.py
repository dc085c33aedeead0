"""Connected components of a distributed edge list (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.plans.joins import uneven_join
from flowguard.session import checkpointed

#: Edges of a node that one task takes: at least this many, and this often the mean of a partition.
HOT_LEAST, HOT_TIMES = 500, 2


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """u -> the least of u and its neighbours (partial sums run before the shuffle)."""
    return pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node of
    ``edges`` that has an edge to another node. Null ends and self loops are left out.

    Each round hangs every node's larger neighbours below its least neighbour, then
    the smaller ones; it stops when a round changes no edge. Neighbours are never
    collected: a node only needs its least one, which is an aggregate joined back
    (``plans/joins.py``: a node with very many edges is dealt to several tasks).
    Every round is written to the checkpoint folder, so lineage stays short.
    """
    now = checkpointed(edges.where(F.col(a) != F.col(b))
                       .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = None
    parts = int(now.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(HOT_LEAST, HOT_TIMES * 2 * now.count() // parts)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (uneven_join(both, _least_neighbour(both), ["u"], hot_rows=most).where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = _least_neighbour(large)
        small = uneven_join(large, low, ["u"], hot_rows=most).select("v", "u", "m")
        pairs = (small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        now = checkpointed(pairs.where(F.col("u") != F.col("v")).distinct())
        mark = now.select(F.count(F.lit(1)).alias("n"),
                          F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == tuple(mark):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = tuple(mark)
