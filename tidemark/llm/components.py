"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import durable


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the least node of its component.

    Each round moves every node to the first of its neighbours and itself, in an order by hash that
    changes with the round, and once more from there.  The links between the nodes that are left go on,
    a fraction of those before, so all rounds together make about as many rows as the first.  Then the
    rounds are followed back.  Every round is a written table and nothing is collected.  Null ends are
    left out; no links give no rows.
    """
    edges = durable(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct(), "links")
    levels = []
    while not levels or not edges.isEmpty():
        place = lambda c: F.struct(F.xxhash64(c, F.lit(len(levels))).alias("h"), F.col(c).alias("v"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = (both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("near"))
                 .select("node", F.least(place("node"), "near")["v"].alias("first")))
        onward = first.select(F.col("node").alias("at"), F.col("first").alias("image"))
        moved = durable(first.join(onward, F.col("first") == F.col("at")).select("node", "image"), "moved")
        levels.append(moved)
        ends = edges
        for end in ("a", "b"):
            to = moved.select(F.col("node").alias(end), F.col("image").alias(f"_{end}"))
            ends = ends.join(to, end)
        edges = durable(ends.filter("_a <> _b").select(F.least("_a", "_b").alias("a"),
                                                       F.greatest("_a", "_b").alias("b")).distinct(), "links")
    found = levels.pop()
    while levels:
        further = found.select(F.col("node").alias("at"), F.col("image").alias("far"))
        found = durable(levels.pop().join(further, F.col("image") == F.col("at"), "left")
                        .select("node", F.coalesce("far", "image").alias("image")), "moved")
    least = found.groupBy("image").agg(F.min("node").alias("label"))
    return durable(found.join(least, "image").select("node", "label"), "labels")
