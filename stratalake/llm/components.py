"""Connected components of a link table, by repeated joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.scratch import discard, store


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the links; ``component`` is the smallest node reachable.

    Large-star and small-star steps in turn (each points nodes at the smallest neighbour seen so far)
    until the links are stars. Each step is two aggregations with map-side combining and one join
    against a written table, so adaptive execution may split a node with very many links. Every
    step is a written table: a lost executor costs tasks, not the lineage. Links with a null end
    and links of a node to itself count as none; no links give an empty table.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    edges = store(edges, "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        old = [edges]
        least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.where("u != v").distinct(), "large")
        old += [least, large]
        least = store(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = store(small.where("u != v").distinct(), "edges")
        discard(*old, least)
        # Both steps leave the components as they are, so equal links mean that they are stars.
        state = edges.agg(F.count("*"), F.coalesce(F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))"), F.lit(0))).first()
        if before == state:
            break
        before = state
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
