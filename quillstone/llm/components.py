"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import remove, split_join, stored

#: Rounds after which something must be wrong: each about halves what is left of the longest path.
ROUNDS = 100
#: Edges from which hubs are split from other nodes; with fewer, a task could take them all.
MANY = 1_000_000


def _tied(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def _with_least(pairs: DataFrame, many: bool, least: DataFrame, name: str) -> DataFrame:
    """``pairs`` (u, v) with m, the least neighbour of u. Hubs of a large graph do not move to one task."""
    if not many:
        return pairs.join(least.drop("degree"), "u")
    return split_join(pairs, stored(least, name), ["u"], "degree")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of ``edges`` (u, v: long, undirected); component is the least node that links reach.

    Each round ties the neighbours of a node to the least of them, first the larger ones, then the smaller; a few rounds
    make every component a star about its least node. Minima are taken before anything moves. Each round is a table in the
    shared folder. No edges, no rows; loops and repeated edges change nothing. Raises if ROUNDS rounds are not enough.
    """
    now = stored(_tied(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    sign = new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    for _ in range(ROUNDS if sign[0] else 0):
        many, old = new[0] > MANY, [now]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("degree"))
        large = _tied(_with_least(both, many, least, "least").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        if many:
            large = stored(large, "edges")
            old.append(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree"))
        small = _with_least(large, many, least, "least").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = stored(_tied(small), "edges")
        sign, new = new, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        for df in old:
            remove(now.sparkSession, df)
        if new == sign:
            break
    else:
        if sign[0]:
            raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
