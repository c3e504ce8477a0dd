"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.storage import kept


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; component is its smallest node.

    ``edges``: columns u, v (bigint). Loops, null ends and repeated edges count for nothing. A round
    shuffles the edges twice and the parents once: a node's smaller neighbours are sorted beside it,
    16 bytes each, and a join that Spark can split moves edges from a node to its parent. Each
    round's edges are written to the shared folder. The number of rounds grows with the logarithm of
    the longest path; the driver sees counts only.
    """
    star = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                             F.least("u", "v").alias("v")), "edges")
    for _ in range(rounds):
        # done when every node has one parent and no parent has a parent
        ends = star.select("u", "v", F.lit(False).alias("parent")).union(
            star.select("v", F.lit(None).cast("long"), F.lit(True)))
        open_nodes = ends.groupBy("u").agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.max("parent").alias("parent")
        ).where("low < high or (parent and low is not null)")
        if not open_nodes.count():
            return (star.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .union(star.select("v", "v")).groupBy("node")
                    .agg(F.min("component").alias("component")))
        # small star: every node and its smaller neighbours hang on the smallest of them
        beside = Window.partitionBy("u").orderBy("v")
        small = (star.select("u", "v", F.first("v").over(beside).alias("m"),
                             F.lag("v").over(beside).alias("before"))
                 .where("before is null or before < v")
                 .select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u"))
                         .alias("u"), F.col("m").alias("v")))
        # large star: larger neighbours hang on the smallest neighbour (or the node itself)
        least = small.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "parent")
        star = kept(small.join(least, F.col("v") == F.col("parent"), "left")
                    .select("u", F.coalesce("m", "v").alias("v")), "edges")
    raise RuntimeError(f"components: not settled after {rounds} rounds")
