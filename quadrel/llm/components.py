"""Connected components of a link table by alternating large and small stars.

Each round rewires links towards smaller neighbours with one aggregate and one join,
so that the rounds needed grow with the logarithm of the longest chain.  No group is
collected: a neighbourhood takes part as its minimum.  Rounds are written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import written


def _star(links: DataFrame) -> DataFrame:
    """For directed links (u, v), hand to every v the least of u and its neighbours: (v, least)."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return links.join(least, "u")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the least node reachable.

    Null ends and links of a node to itself carry no information and are left out; an
    empty table gives an empty result.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, name)
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _star(large)
        edges = (
            small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .unionByName(small.select("u", F.col("least").alias("v")))
            .where("u != v")
            .distinct()
        )
        edges = written(edges, name)
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("u"), "root").distinct()).withColumnRenamed("u", "node")
