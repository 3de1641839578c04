"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.session import stable


def components(links: DataFrame, rounds: int = 200) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every end of the links ``a``, ``b``.

    Each round every node takes the smallest label among its neighbours and then the label of
    that label, so the number of rounds follows the logarithm of a component's reach. Only
    the number of changed rows is brought to the driver. Minima are taken on the map side,
    so a node with very many links is a row per task.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stable(both.where("a != b").distinct())
    state = stable(edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")))
    for _ in range(rounds):
        seen = edges.join(state, edges.b == state.node).groupBy("a").agg(F.min("component").alias("near"))
        lower = state.join(seen, state.node == seen.a).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        lower = stable(lower)
        label = lower.select(F.col("node").alias("l_node"), F.col("mid").alias("l_mid"))
        jumped = lower.join(label, lower.mid == label.l_node, "left").select(
            "node", "old", F.least("mid", F.coalesce("l_mid", "mid")).alias("component")
        )
        state = stable(jumped)
        if state.where("component != old").isEmpty():
            return state.select("node", "component")
        state = state.select("node", "component")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
