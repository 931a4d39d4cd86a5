"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotaxa.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b: long), where the
    component is the smallest node that can be reached.  Self-loops name a
    node without linking it; rows with a null end are ignored.

    Each round points every node at its smallest neighbour, follows two
    pointers and replaces both ends of every edge, so edges vanish as their
    ends meet; the rounds grow with the logarithm of the graph.  Both tables
    are written to the shared checkpoint folder once a round."""
    edges = edges.where("a is not null and b is not null").select(F.col("a").cast("long"), F.col("b").cast("long"))
    both = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialize(both.select("node", F.col("node").alias("component")), "labels")
    links = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while links.head(1):
        ends = links.unionAll(links.select("b", "a")).toDF("node", "other")
        parent = ends.groupBy("node").agg(F.min("other").alias("up")).select("node", F.least("node", "up").alias("up"))
        parent = materialize(parent, "parents")
        for _ in range(2):
            above = parent.toDF("_n", "_up")
            parent = parent.join(above, F.col("up") == F.col("_n"), "left").select("node", F.coalesce("_up", "up").alias("up"))
        parent = materialize(parent, "parents")
        up_a, up_b, up_c = (parent.toDF(f"_n{x}", f"_up{x}") for x in "abc")
        links = links.join(up_a, F.col("a") == F.col("_na"), "left").join(up_b, F.col("b") == F.col("_nb"), "left").select(
            F.coalesce("_upa", "a").alias("a"), F.coalesce("_upb", "b").alias("b")).where("a <> b")
        links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        labels = materialize(labels.join(up_c, F.col("component") == F.col("_nc"), "left").select(
            "node", F.coalesce("_upc", "component").alias("component")), "labels")
    return labels
