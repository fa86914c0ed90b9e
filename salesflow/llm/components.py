"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesflow.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for the ends of all edges (``a``, ``b``; not null).

    Labels spread along edges and then jump to the label of their label, so rounds grow with the
    logarithm of a component's width. Every round is written; no group is gathered.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(
            F.min("component").alias("near")).withColumnRenamed("a", "node")
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        spread = stage(hooked, "labels-spread")
        up = spread.select(F.col("node").alias("component"), F.col("component").alias("above"))
        jumped = stage(spread.join(up, "component").select(
            "node", "old", F.col("above").alias("component")), "labels")
        labels = jumped.select("node", "component")
        if jumped.where("component <> old").isEmpty():
            return labels


def merge_components(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """``labels`` of ``components`` after more edges; None if there were and are none.

    Both ends are replaced by their components first and what then joins a component to itself is dropped, so a dense
    group costs as much as its vertices, not its links: only the graph of components that meet is labelled.
    """
    ends = edges.select("a", "b")
    for end in ("a", "b") if labels is not None else ():
        own = labels.select(F.col("node").alias(end), "component")
        ends = ends.join(own, end, "left").select(
            F.coalesce("component", end).alias(end), *[c for c in ("a", "b") if c != end])
    met = stage(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "met")
    if met.isEmpty():
        return labels
    joined = components(met)
    if labels is None:
        return joined
    above = joined.select(F.col("node").alias("component"), F.col("component").alias("above"))
    moved = labels.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return stage(moved.unionByName(joined.join(labels, "node", "left_anti").select("node", "component")), "labels")
