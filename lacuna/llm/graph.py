"""Connected components by alternating large and small stars, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lacuna.llm.common import discard, written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the least node of each node's component, for all nodes of edges (u, v).

    Each half round is a grouped minimum and a join back, so that no node's neighbours meet in one
    place; a hub's join is one that adaptive execution can split. Null ends and loops are ignored."""
    ends = edges.where("u is not null and v is not null and u <> v")
    e = written(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    was = None
    for _ in range(rounds):
        before = e
        # large star: what lies above a node moves to the node's least neighbour
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        e = e.join(least, e["v"] == least["k"]).select(e["u"], "m").where("u <> m").withColumnRenamed("m", "v").distinct()
        # small star: what lies below a node moves to the least of it
        least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        moved = e.join(least, e["u"] == least["k"])
        e = moved.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = written(e, "stars")
        discard(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
