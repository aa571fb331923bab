"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quern.llm.storage import discard, materialize


def _edges(df: DataFrame) -> DataFrame:
    return df.filter("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    """(node, other) for each end of each edge."""
    return edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(edges.select(F.col("v").alias("node"), F.col("u").alias("other")))


def _hang(pairs: DataFrame, keep_larger: bool) -> DataFrame:
    """Hang the neighbours of each node (of ``pairs``: node, other; read from a table) on its
    smallest one, and return the new edges as a table.

    The minimum is a partial aggregate. Both sides of the join are read from tables, so that Spark
    can split a node with very many neighbours over tasks.
    """
    least = materialize(pairs.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least")), "least")
    joined = pairs.join(least, "node")
    if keep_larger:
        hung = joined.filter("other > node").select(F.col("other").alias("u"), F.col("least").alias("v"))
    else:
        hung = joined.select(F.col("other").alias("u"), F.col("least").alias("v")).union(least.select(F.col("node").alias("u"), F.col("least").alias("v")))
    edges = materialize(_edges(hung), "edges")
    discard(least)
    return edges


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (u, v) to (node, component): the smallest node that each linked node reaches.

    Nodes without a link are not returned. Loops, repeats and nulls are ignored. Every round writes
    its edges to the shared folder, so a lost executor costs a round at most, and deletes those of
    the round before.
    """
    now = materialize(_edges(edges.select("u", "v")), "edges")
    for _ in range(max_rounds):
        large = _hang(_both_ways(now), keep_larger=True)
        discard(now)
        now = _hang(large.select(F.col("u").alias("node"), F.col("v").alias("other")), keep_larger=False)
        discard(large)
        # settled: every larger end hangs on one node, which hangs on none
        rows, hanging = now.agg(F.count("*"), F.countDistinct("u")).first()
        if rows == hanging and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
