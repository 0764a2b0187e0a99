"""Connected components of a graph given as links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.session import cut


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Each round takes the least root among the neighbours, then the root of the root, and is written out; the number of
    rounds grows with the logarithm of the longest chain in the usual case. Hot nodes are reduced before the shuffle,
    joins on them are split by the adaptive planner. Self links and repeated links do no harm; no links, no rows.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    roots = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        near = both.join(roots, both["b"] == roots["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = cut(roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("before")))
        above = lower.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        jumped = cut(lower.join(above, "root", "left").select("node", F.least("root", F.coalesce("upper", "root")).alias("root"), "before"))
        moved = jumped.where("root <> before").limit(1).count()
        roots = jumped.select("node", "root")
        if not moved:
            return roots
