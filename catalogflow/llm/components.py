"""Connected components of links between rows, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); ``root`` is the least node of its component.

    Each round hangs every node and its greater neighbours below the least node known to it
    (large star, then small star), which about halves the depth; it ends when no link changes.
    Each round's links are written to the shared folder. Null nodes and loops are ignored.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialize(edges.distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        following = materialize(small, "links")
        done = (
            following.join(edges, ["a", "b"], "left_anti").isEmpty()
            and edges.join(following, ["a", "b"], "left_anti").isEmpty()
        )
        edges = following
        if done:
            break
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
