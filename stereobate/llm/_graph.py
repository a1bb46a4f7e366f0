"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stereobate.llm._io import drop, save


SALTS = 8


def _salted(pairs: DataFrame, low: DataFrame) -> DataFrame:
    """``pairs(u, v)`` with ``m`` of ``low(u, m)``; the rows of one ``u`` are dealt over SALTS tasks by ``v``."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    return salted.join(low.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["u", "salt"])


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)`` with the smallest reachable node as component.

    Nodes without an edge don't appear. Each round hangs every larger neighbour of a node on the node's least
    neighbour (large star), then every smaller neighbour (small star); the number of rounds grows with the logarithm
    of the node count. Minima come from partial aggregates and joins on a node are salted by its neighbour, so that a
    hub's neighbours never meet in one task; each round is written to the shared folder. Null ends and loops are left
    out.
    """
    at = save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _salted(large, low).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = save(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        drop(at)
        at = new
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
