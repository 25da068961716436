"""Connected components by alternating large-star and small-star steps (min id as label).

Each step is a min-aggregate (combined before the shuffle) joined back to the edges, so no
neighbour list is ever collected. Every step is written to the checkpoint folder, the one before
it is removed, and the loop ends when a round changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tixprep.llm.tables import Steps


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` with integer ids -> ``(node, component)`` for every node with an edge to
    another node; ``component`` is the smallest id reachable. Self-links and repeated or reversed
    links are fine; rows with a null end are no link."""
    steps = Steps(edges)
    links = steps.write(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _signature(links)
    while seen[0]:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("k"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        large = steps.write(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = steps.write(
            large.join(lowest.select(F.col("a").alias("k"), "m"), F.col("a") == F.col("k"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
            .unionAll(lowest.select("a", F.col("m").alias("b"))).distinct())
        now = _signature(small)
        steps.drop(links)
        steps.drop(large)
        links = small
        if now == seen:
            break
        seen = now
    stars = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
