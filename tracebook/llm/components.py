"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import forget, stored


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``links`` (left, right): root is the smallest reachable.

    Each round takes the smallest label among the neighbours and then the label of that label,
    so chains halve. Minima combine before the shuffle; labels are one row per node, so the
    joins have a unique side and skewed keys can be split. Stops when a round changes nothing.
    """
    both = stored(
        links.select(F.col("left").alias("node"), F.col("right").alias("other"))
        .union(links.select("right", "left"))
        .where("node <> other")
        .distinct()
    )
    labels = stored(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
    )
    for _ in range(rounds):
        near = (
            both.join(labels.select(F.col("node").alias("other"), "root"), "other")
            .groupBy("node")
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("next"))
        step = stored(
            lower.join(jump, "via").select("node", "old", F.least("via", "next").alias("root"))
        )
        changed = step.where("root <> old").limit(1).count()
        forget(labels)
        labels = step.select("node", "root")
        if not changed:
            forget(both)
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
