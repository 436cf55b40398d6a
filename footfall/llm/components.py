"""Connected components of a graph given as edges, smallest id first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.settings import materialize


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, component) with the smallest id that can be reached.

    Alternates large-star and small-star steps: neighbours are hung on the
    smallest id around them until nothing changes. Every step is a minimum per
    node, summed up before it is shuffled, and a join back; each is written to
    the shared folder. Nodes without an edge to another node are not returned.
    """
    stars = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    while True:
        # Large star: every neighbour above u is hung on the smallest around u.
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = materialize(large, "large")
        # Small star: every neighbour below u, and u, are hung on the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        small = materialize(small, "small")
        same = small.count() == stars.count() and not small.join(stars, ["u", "v"], "left_anti").take(1)
        stars = small
        if same:
            break
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
