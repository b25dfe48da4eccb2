"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links`` (two columns of ids); component is the least id reachable.

    Both steps replace a node's links by links to its least neighbour.  Minima are aggregated before they are
    joined back, so that a hub is one row of an aggregate and a join whose skewed side Spark splits, never one
    task's group.  The steps end when the links no longer change, after about log(longest path) rounds.
    """
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = materialise(edges, "links")
    before = _signature(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
