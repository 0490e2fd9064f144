"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.operators.skew import spread_join
from txlake.plans.session import shared_folder


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the larger node `u` to the smaller `v`, each once."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(
        F.col("u") != F.col("v")
    ).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the edges (u, v): the smallest node that each one reaches.

    Alternating star contraction: every node passes its smallest neighbour to its larger neighbours, then to
    its smaller ones, until nothing changes; the number of rounds grows with the logarithm of the longest path.
    A node with very many edges is only joined to its own minimum, a join that Spark can split (`spread_join`), and minima are combined
    before the shuffle. Each round is written to the checkpoint folder. No edges give no rows.
    """
    shared_folder(edges.sparkSession)
    now = _ordered(edges).checkpoint()
    state = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == (seen.n, seen.s):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct()
            )
        state = (seen.n, seen.s)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = spread_join(both, least, "u", "inner").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread_join(large, lowest, "u", "inner").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v")
        now = _ordered(small).checkpoint()
