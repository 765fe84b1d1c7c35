"""Connected components of links, by smallest labels and shortcuts, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import delete_path, materialize


def drop_table(stored: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in stored.inputFiles()}:
        delete_path(stored.sparkSession, folder)


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (smallest node reachable) for every node of links (a, b).

    Every round lets a node take the smallest label among its own and its neighbours',
    and hands that label to the node whose label it had (a tree is hung below a smaller
    root), then labels jump to their label's label. Rounds grow with the logarithm of a
    component's width. Minima are taken in every task before the shuffle, so a node with
    a third of all links is one row per task there; each round is a stored table, so a
    lost executor costs a round.
    """
    both = links.select("a", "b").union(links.selectExpr("b as a", "a as b"))
    edges, count = materialize(both.where("a <> b").distinct(), f"{name}-links")
    labels, _ = materialize(
        edges.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"),
        f"{name}-labels",
    )
    changed = count
    while changed:
        seen = edges.join(labels, edges["b"] == labels["node"]).select("a", "label")
        offered = (
            seen.union(labels.select("node", "label")).groupBy("a").agg(F.min("label").alias("offer"))
        )
        nodes = labels.join(offered, labels["node"] == offered["a"]).select("node", "label", "offer")
        hung = nodes.select(F.col("label").alias("node"), "offer")
        lower = (
            nodes.select("node", "offer").union(hung).groupBy("node").agg(F.min("offer").alias("lower"))
        )
        over = lower.select(F.col("node").alias("root"), F.col("lower").alias("above"))
        jumped = lower.join(over, lower["lower"] == over["root"], "left").select(
            "node", F.least("lower", "above").alias("new")
        )
        step = labels.join(jumped, "node").select(
            "node", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("changed")
        )
        stored, _ = materialize(step, f"{name}-labels")
        changed = stored.where("changed").limit(1).count()
        drop_table(labels)
        labels = stored.select("node", "label")
    drop_table(edges)
    return labels.select("node", F.col("label").alias("component"))
