"""Connected components of links, by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import written


def _stars(edges: DataFrame) -> bool:
    """Whether every node either has one least node beside it or is one: then nothing is left to do."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    seen = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return seen.filter("child + parent > 1").isEmpty()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of links (u, v), the component being its least node; nodes without links aren't there.

    An error is raised where most_rounds don't suffice.

    Each round is written to the shared folder and holds no more links than there are. A star's
    centre with many links is met by aggregation and by joins, which Spark can split.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    for _ in range(most_rounds):
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("v", "m").filter("v <> m").unionByName(least.select(F.col("u").alias("v"), "m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = written(small, "links")
    else:
        if not _stars(edges):
            raise RuntimeError(f"components are not final after {most_rounds} rounds")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
