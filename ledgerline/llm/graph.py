"""Connected components as Spark joins: every node gets the smallest node id it can reach.

Each round hooks every node onto its smallest neighbour and doubles pointers up to the roots, so at
least half of the nodes that still have an edge go; chains take logarithmically many jumps. Edges shrink to edges
between labels, and only labels that still have an edge take part. Each round's tables are written
to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; nodes without edges are not listed."""
    spark = edges.sparkSession
    at = scratch_dir(spark, "components")
    pairs = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo <> hi").distinct()
    pairs = _written(pairs, f"{at}/edges-0")
    labels = None
    step = 0
    while not pairs.isEmpty():
        step += 1
        both = pairs.select(F.col("lo").alias("node"), F.col("hi").alias("other")).unionByName(
            pairs.select(F.col("hi").alias("node"), F.col("lo").alias("other")))
        # every node points at the smallest of itself and its neighbours, then at the root of that
        parent = both.groupBy("node").agg(F.least("node", F.min("other")).alias("up"))
        parent = _written(parent, f"{at}/parent-{step}")
        jump, moving = 0, True
        while moving:
            jump += 1
            further = _relabel(parent.withColumn("was", F.col("up")), "up", parent)
            parent = _written(further.withColumn("moved", F.col("up") != F.col("was")).drop("was"),
                              f"{at}/parent-{step}-{jump}")
            moving = not parent.filter("moved").isEmpty()
            parent = parent.drop("moved")
        labels = parent.select("node", F.col("up").alias("component")) if labels is None else _written(
            _relabel(labels, "component", parent), f"{at}/labels-{step}")
        moved = _relabel(_relabel(pairs, "lo", parent), "hi", parent)
        pairs = _written(moved.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"))
                         .filter("lo <> hi").distinct(), f"{at}/edges-{step}")
    if labels is None:
        return pairs.select(F.col("lo").alias("node"), F.col("hi").alias("component"))
    return labels


def _relabel(df: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Replace ``column`` by its parent where it has one."""
    up = parent.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
    return (df.join(up, F.col(column) == F.col("_node"), "left")
            .withColumn(column, F.coalesce("_up", column)).drop("_node", "_up"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
