"""Connected components of an edge table: alternating large-star and small-star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, comp) for each id that an edge (a, b) has: comp is the smallest id that it is linked with. Edges with a null end are left out.

    A step looks at a node's smallest neighbour only (an aggregate with map-side part), so no neighbourhood is gathered. Each
    aggregate is written to the shared folder before it is joined back, so that Spark can split the join at a hot node. It ends
    when every edge leads to a node from which none leads on.
    """
    both_ends = lambda df: df.where("u <> v").distinct()
    now = stored(both_ends(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))), name)
    while True:
        n = now.count()
        ends = now.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
        both = now.union(now.select("v", "u"))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name, 2 * n)
        large = stored(both_ends(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))), name, n)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), name, n)
        small = large.join(least, "u").select("u", "v", "m")
        now = stored(both_ends(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))), name, 2 * n)
    return now.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(now.select("v", "v").distinct())
