"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.scratch import cut, packed

EDGES_A_PART = 500_000  # edges are two numbers: fewer, fuller partitions write fewer shuffle files


def components(edges: DataFrame, edges_at_most: int | None = None) -> DataFrame:
    """Every id in `edges` (columns a, b; any order, repeats allowed) with the smallest id it can reach: (id, component).

    Alternating large-star and small-star steps: edges are redirected to the smallest neighbour until every id points at
    its component. Only the number of edges and a checksum reach the driver; a hot id is an aggregate before the shuffle
    and the unique side of the joins. Where `edges_at_most` is known, they are first written to as few files as they need.
    """
    current = (
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    current = cut(current if edges_at_most is None else packed(current, edges_at_most, EDGES_A_PART))
    seen = None
    while True:
        mark = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        parts = 1 + mark["n"] // EDGES_A_PART
        if seen == mark or mark["n"] == 0:
            return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                current.select("v", "v")
            ).groupBy("id").agg(F.min("component").alias("component")).coalesce(parts)
        seen, current = mark, current.coalesce(parts)
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(lowest, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(parts).distinct().coalesce(parts)  # no step makes more edges than it gets
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut(small.union(lowest.select("u", F.col("m").alias("v"))).coalesce(parts).distinct().coalesce(parts))
