"""Connected components over links, by least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.session import stored


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after joining what ``links`` (a, b) connect.

    Works on labels, not nodes: links become pairs of labels, and each round every label
    takes the least label it is connected with, then the label of that label. Rounds are
    written to the shared folder; their number grows with the logarithm of the longest
    chain in practice.
    """

    def saved(df: DataFrame) -> DataFrame:
        return stored(df, "components")

    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    edges = links.join(of_a, "a").join(of_b, "b").filter("x <> y").select("x", "y")
    edges = saved(edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    if edges.isEmpty():
        return labels
    best = saved(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("to")))
    while True:
        to_x = best.select("x", F.col("to").alias("tx"))
        to_y = best.select(F.col("x").alias("y"), F.col("to").alias("ty"))
        # what the roots on both ends of a link can be lowered to
        ends = edges.join(to_x, "x").join(to_y, "y").filter("tx <> ty")
        hooks = ends.groupBy(F.greatest("tx", "ty").alias("x")).agg(F.min(F.least("tx", "ty")).alias("hook"))
        lowered = best.join(hooks.select(F.col("x").alias("to"), "hook"), "to", "left").select(
            "x", F.coalesce("hook", "to").alias("to")
        )
        jump = lowered.select(F.col("x").alias("to"), F.col("to").alias("next"))
        moved = saved(
            lowered.join(jump, "to", "left").select("x", F.coalesce("next", "to").alias("to"))
        )
        done = moved.join(best.withColumnRenamed("to", "was"), "x").filter("to <> was").isEmpty()
        best = moved
        if done and ends.isEmpty():
            break
    return labels.join(best.select(F.col("x").alias("label"), "to"), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label")
    )
