"""Connected components of a graph given as edges, by alternating large and small stars.

The method is the public one of Kiveris and others, 2014: every round is a few
joins and minimum aggregations, so no component is ever gathered anywhere. The
round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where(F.col("v") < F.col("u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(low, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the component's smallest node.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    now = stored(edges.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "edges")

    def mark(frame: DataFrame) -> tuple:
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    last = None
    while last != (last := mark(now)):
        now = stored(_star(_star(now, large=True), large=False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
