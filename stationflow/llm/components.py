"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that can be reached, for each node of links (a, b).

    Each round points every node at the least node next to it and every such target at that one's own target, which
    halves the length of chains; it ends when nothing changes. A node with very many links is no hot key to its
    rounds' minimum, which is taken before the shuffle. Each round is written to the shared folder.
    """
    links = links.select("a", "b").filter("a <> b")
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(most_rounds):
        near = both.join(now.select(F.col("node").alias("b"), F.col("component").alias("near")), "b")
        # A node hears the least component next to it; and the component it had hears it as well.
        heard = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = now.join(heard, "node").select("node", "component", F.least("component", "near").alias("least"))
        told = step.filter("least < component").groupBy(F.col("component").alias("node")).agg(F.min("least").alias("told"))
        step = step.join(told, "node", "left").select("node", "component", F.least("least", F.coalesce("told", "least")).alias("least"))
        jump = step.select(F.col("node").alias("_node"), F.col("least").alias("_jump"))
        after = written(step.join(jump, F.col("least") == F.col("_node"), "left").select("node", F.least("least", F.coalesce("_jump", "least")).alias("component"), F.col("component").alias("was")))
        changed = after.filter("component <> was").limit(1).count()
        now = after.select("node", "component")
        if not changed:
            return now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
