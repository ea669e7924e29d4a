"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``, the component
    being its smallest node.

    Each round links every neighbour to the smallest one it sees (large star),
    then the smaller neighbours likewise (small star); the edge set never
    grows and becomes one star per component in about log rounds. Every round
    is written out, so lineage stays one round deep; only two numbers per
    round reach the driver.
    """
    def star(e: DataFrame) -> DataFrame:
        return e.where(F.col("a") != F.col("b")).distinct()

    cur = scratch.write(star(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))),
                        "edges-0")
    mark = _mark(cur)
    for i in range(1, max_rounds + 1):
        if mark[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = star(both.where(F.col("b") > F.col("a")).join(low, "a")
                     .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = scratch.write(large, f"large-{i}")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        nxt = scratch.write(star(small), f"edges-{i}")
        scratch.drop(f"large-{i}")
        scratch.drop(f"edges-{i - 1}")
        cur, old, mark = nxt, mark, _mark(nxt)
        if mark == old:
            break
    else:
        raise RuntimeError("components did not settle")
    low = cur.groupBy("a").agg(F.min("b").alias("component"))
    return low.select(F.col("a").alias("node"), "component").unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return int(r["n"]), r["s"]
