"""Connected components by alternating large-star and small-star steps.

Each step is one aggregate (smallest neighbour of a node, with map-side combine) and one join of the edges with it;
edges only ever move to smaller nodes, so their number never grows beyond the first large-star. Node columns may be of
any orderable type. Lineage is cut by ``checkpoint()`` into the folder named by ``spark.checkpoint.dir``; nothing
passes through the driver but counts and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.session import checkpoint_dir


def shared_checkpoint(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v: every larger neighbour of a node moves to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with u > v: a node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v); root is the smallest node of its component.
    Loops and repeated edges are allowed; a table without edges between different nodes gives no rows."""
    e = shared_checkpoint(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        e = shared_checkpoint(_small_star(_large_star(e)))
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def no_edges(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], f"u {kind}, v {kind}")
