"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step links every node's neighbours to the least of them; the links end as stars around the
least node of each component. Steps are aggregates and joins, and the links are written to the
shared folder after each round, so the lineage stays short and nothing reaches the driver but
a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; the root is the least node."""
    pair = F.when(F.col(a) > F.col(b), F.struct(F.col(a).alias("u"), F.col(b).alias("v"))).otherwise(
        F.struct(F.col(b).alias("u"), F.col(a).alias("v"))
    )
    edges = links.filter(F.col(a) != F.col(b)).select(pair.alias("p")).select("p.u", "p.v").distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        # large star: later neighbours go to the least of u and its neighbours
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: earlier neighbours, and u itself, go to the least of them
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = written(small.distinct(), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mixed).cast("decimal(38,0)").alias("s")).first()
    return row["n"], row["s"]
