"""Graph construction, degrees, neighbourhoods and slices.

An undirected graph is a table (src, dst, ...) with src <= dst and one row per pair; a directed graph has one
row per ordered pair. Edge rows are reduced to pairs before anything else, so repeated rows of one hot pair
never travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.functions import style
from newsweave.operators.aggregates import percentile_threshold
from newsweave.operators.joins import induced_subgraph
from newsweave.operators.ordering import collapse_edges
from newsweave.session import cut, scalar


def edge_weights(edges: DataFrame) -> DataFrame:
    """Rows per ordered pair of non-null ends."""
    known = edges.filter("source is not null and target is not null")
    return known.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def undirected_weighted(edges: DataFrame, weight: str = "last") -> DataFrame:
    """Unordered pairs with a weight.

    ``last``: where both directions exist, the count of the pair that sorts later wins. ``sum``: both add up.
    """
    known = edges.filter("source is not null and target is not null")
    forward, back = F.count_if(F.col("source") <= F.col("target")), F.count_if(F.col("source") > F.col("target"))
    merged = forward + back if weight == "sum" else F.when(back > 0, back).otherwise(forward)
    return known.groupBy(F.least("source", "target").alias("src"), F.greatest("source", "target").alias("dst")).agg(
        merged.alias("weight")
    )


def directed_simple(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Ordered pairs, each with the attributes of its last row."""
    return collapse_edges(edges, directed=True, order=order)


def undirected_attributed(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Unordered pairs, each with the attributes of its last row."""
    return collapse_edges(edges, directed=False, order=order)


def to_undirected(directed: DataFrame) -> DataFrame:
    """Merge reciprocal edges; weight 1."""
    pairs = directed.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    return pairs.withColumn("weight", F.lit(1))


def graph_nodes(edges: DataFrame, src: str = "source", dst: str = "target") -> DataFrame:
    """Distinct non-null ends."""
    return edges.select(F.explode(F.array(src, dst)).alias("node")).filter("node is not null").distinct()


def degree_table(graph: DataFrame) -> DataFrame:
    """in_degree, out_degree and degree per node of a graph with one row per pair; a self loop counts twice."""
    ends = graph.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        ).alias("end")
    ).select("end.*")
    return (
        ends.groupBy("node")
        .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
        .withColumn("degree", F.col("in_degree") + F.col("out_degree"))
    )


def degree_centrality(graph: DataFrame) -> DataFrame:
    """Degrees and their shares of n-1; every share is 1 in a graph of one node."""
    degrees = degree_table(graph)
    others = scalar(degrees, F.count(F.lit(1))) - 1

    def share(column):
        return F.when(others > 0, F.col(column) / others).otherwise(F.lit(1.0))

    return degrees.withColumns(
        {
            "in_centrality": share("in_degree"),
            "out_centrality": share("out_degree"),
            "degree_centrality": share("degree"),
        }
    )


def row_degrees(edges: DataFrame) -> DataFrame:
    """Incoming and outgoing edge rows per node, parallel edges counted each."""
    return degree_table(edges.select(F.col("source").alias("src"), F.col("target").alias("dst")))


def min_degree_subgraph(graph: DataFrame, min_exclusive: int = 2) -> DataFrame:
    """Edges among the nodes whose degree exceeds the bound; one pass, not a core."""
    kept = degree_table(graph).filter(F.col("degree") > min_exclusive).select("node")
    return induced_subgraph(graph, kept)


def ego_search(graph: DataFrame, term: str) -> DataFrame:
    """Edges among the nodes whose name contains the term and their direct neighbours."""
    if not term:
        return graph
    touching = graph.filter(style.matches(F.col("src"), term) | style.matches(F.col("dst"), term))
    return induced_subgraph(graph, graph_nodes(touching, "src", "dst"))


def khop(graph: DataFrame, seeds: DataFrame, k: int = 2) -> DataFrame:
    """Nodes within k steps of the seeds, either direction, with their nearest ring."""
    reached = cut(seeds.toDF("node").distinct().withColumn("hop", F.lit(0)))
    both = graph.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))))
    both = both.select("col.src", "col.dst").filter("src <> dst")
    for step in range(1, k + 1):
        # the ring is a set of distinct nodes: a semi join, so hub edges are probed but never multiplied
        ring = reached.filter(F.col("hop") == step - 1).select(F.col("node").alias("src"))
        found = both.join(ring, "src", "left_semi").select(F.col("dst").alias("node")).distinct()
        fresh = found.join(reached, "node", "left_anti").withColumn("hop", F.lit(step))
        reached = cut(reached.unionByName(fresh))
    return reached


def label_nodes(nodes: DataFrame, column: str = "degree_centrality", share: float = 0.9) -> DataFrame:
    """Nodes at or above the given percentile."""
    return nodes.filter(F.col(column) >= percentile_threshold(nodes, column, share).scalar())


def labels_above(nodes: DataFrame, column: str, bound: float, inclusive: bool = True) -> DataFrame:
    """Nodes at or above a fixed bound."""
    return nodes.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def top_nodes(edges: DataFrame, n: int = 20, order: str = "seq") -> DataFrame:
    """Nodes of highest degree centrality; ties by first appearance, sources before targets of one row."""
    graph = directed_simple(edges, order)
    seen = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("source").alias("node"), F.struct(F.col(order), F.lit(0)).alias("at")),
                F.struct(F.col("target").alias("node"), F.struct(F.col(order), F.lit(1)).alias("at")),
            )
        ).alias("s")
    ).select("s.*")
    first = seen.groupBy("node").agg(F.min("at").alias("first_at"))
    ranked = degree_centrality(graph).join(first, "node")
    return ranked.orderBy(F.desc("degree"), "first_at").limit(n).select("node", "degree", "degree_centrality")


def daily_edges(edges: DataFrame) -> DataFrame:
    """Edge rows per day and relationship."""
    return edges.filter("date is not null").groupBy("date", "relationship").agg(F.count(F.lit(1)).alias("n"))


def by_sentiment_and_relationship(edges: DataFrame) -> DataFrame:
    """Edge rows per sentiment and relationship, empty combinations included.

    Both domains are closed vocabularies; they are combined inside one row, not by a join of row sets.
    """
    counts = edges.groupBy("sentiment", "relationship").agg(F.count(F.lit(1)).alias("n"))
    domains = counts.agg(F.collect_set("sentiment").alias("s"), F.collect_set("relationship").alias("r"))
    combos = domains.select(F.explode("s").alias("sentiment"), "r").select("sentiment", F.explode("r").alias("relationship"))
    return combos.join(counts, ["sentiment", "relationship"], "left").fillna({"n": 0})


def edges_by(edges: DataFrame, column: str) -> DataFrame:
    """Edge rows and distinct pairs per value of one attribute."""
    pairs = edges.groupBy(column, "source", "target").agg(F.count(F.lit(1)).alias("rows"))
    return pairs.groupBy(column).agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("pairs"))
