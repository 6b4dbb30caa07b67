"""Connected components of a link table, as joins and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from paymart.session import stored_once


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): for each node of a link, the smallest node of its
    component. Links may repeat and stand in either direction.

    Each round, a node takes the smallest label among its own and its
    neighbours', and then the label of that label, so distances halve. Labels
    are folded per task before each shuffle, so a node with very many links is
    no load. A round is one job: its labels are written to the shared folder, and
    how many have changed is counted on the way; the loop ends at none.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = stored_once(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = stored_once(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
                         .select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "label"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                F.least("label", "near").alias("mid"))
        up = labels.select(F.col("node").alias("mid"), F.col("label").alias("top"))
        changes = Observation()
        moved = (step.join(up, "mid").select("node", "old", F.least("mid", "top").alias("label"))
                 .observe(changes, F.count_if(F.col("old") != F.col("label")).alias("n")))
        labels = stored_once(moved.select("node", "label"), "labels")
        if not changes.get["n"]:
            return labels


def joined_components(labels: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``labels`` (node, label) with more links: only the graph between components
    that the new links connect is worked on. Nodes of links may be new."""
    def label_of(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))

    between = stored_once(
        links.join(label_of(a), a, "left").join(label_of(b), b, "left")
        .select(F.coalesce(f"{a}_label", a).alias("a"), F.coalesce(f"{b}_label", b).alias("b"))
        .where("a <> b").distinct(), "links-between")
    top = connected_components(between).select(F.col("node").alias("label"), F.col("label").alias("top"))
    # nodes of components, and single nodes that are linked for the first time
    known = labels.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    new = (top.join(labels.select(F.col("label")).distinct(), "label", "left_anti")
           .select(F.col("label").alias("node"), F.col("top").alias("label")))
    return known.unionByName(new)
