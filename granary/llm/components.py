"""Connected components by alternating star contractions (large star, small star).

Each round is two joins on the edges with the smallest neighbour of each node; a node with very many neighbours is a hot key of
these joins, which adaptive execution splits, and its minimum is aggregated before it moves. Rounds are written to the
shared folder, so lineage stays short and a lost executor costs a task; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_anew, removed, written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (src, dst: long); component is the smallest node reachable.

    Edges may repeat, run in either direction or form loops; edges with a null end are passed over.
    """
    spark = edges.sparkSession
    u, v = F.col("u"), F.col("v")
    proper = edges.where("src is not null and dst is not null and src <> dst")
    e = proper.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    paths: list[str] = []
    e, before = written(e, spark, paths), None
    for _ in range(rounds):
        count = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if count == before or not count[0]:
            break
        before = count
        both = e.unionByName(e.select(v.alias("u"), u.alias("v")))
        least = dealt_anew(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "u")
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        # small star: every edge of `large` has u > v
        least = dealt_anew(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), spark, paths)
        removed(spark, paths[:-1])
        del paths[:-1]
    else:
        raise RuntimeError("components did not settle")
    children = e.select(u.alias("node"), v.alias("component"))
    roots = e.select(v.alias("node")).distinct().select("node", F.col("node").alias("component"))
    return children.unionByName(roots)
