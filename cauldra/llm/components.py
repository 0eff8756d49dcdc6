"""Connected components by alternating stars.

Each round links every node's larger neighbours to the smallest node around it (large star), then its
smaller neighbours to the smallest (small star). Components become stars in a number of rounds that
grows with the logarithm of their diameter. Links and labels never leave the cluster; each round's
links are written to the checkpoint folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, component) of every node that has a link, component being its smallest node.

    Links are undirected; loops, repeated links and links with a null end add nothing. No links give
    an empty result. Raises ``RuntimeError`` after ``rounds`` rounds without convergence.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    # (u, v) with u > v
    now = checkpointed(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("l")).select("l.*").filter("u <> v").distinct()
        now = checkpointed(small)
        # A star forest is a fixed point; equal sums of link hashes are taken as equal links.
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        before = mark
    raise RuntimeError(f"no convergence in {rounds} rounds")
