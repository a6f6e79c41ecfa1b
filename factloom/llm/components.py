"""Connected components by contraction, in written rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import stored


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` of every node that has a link; the component is its lowest node.

    Each round gives a node the lowest of itself and its neighbours, then
    relabels the links and drops those inside a node. A node with very many
    links is folded before the shuffle (``min``) and its rows are split by
    adaptive skew joins. Null ends and loops are ignored. No link: no row.
    """
    edges = stored(
        links.select(F.col(left).cast("long").alias("a"), F.col(right).cast("long").alias("b"))
        .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    found: DataFrame | None = None
    while not edges.isEmpty():
        ends = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        parents = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                         .select("node", F.least("node", "low").alias("component")), "parents")
        if found is None:
            found = parents
        else:
            up = parents.select(F.col("node").alias("component"), F.col("component").alias("next"))
            found = found.join(up, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        a = parents.select(F.col("node").alias("a"), F.col("component").alias("pa"))
        b = parents.select(F.col("node").alias("b"), F.col("component").alias("pb"))
        edges = stored(
            edges.join(a, "a").join(b, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "links",
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stored(found, "components")
