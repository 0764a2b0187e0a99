"""Joins.

Lookup sides have one row per key, so a hot key only makes the probe side uneven. A lookup side that was
computed by grouping on the join key is written out first (``cut``): joined directly, it would keep the
partitioning of its grouping, and the adaptive planner only splits a hot key where both sides come straight
from a shuffle. Written out, its size is measured as well, and it is broadcast only below the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.operators.ordering import keep_one
from newsweave.session import cut


def join_on_key(left: DataFrame, right: DataFrame, key: str = "url") -> DataFrame:
    """Inner equi-join; other columns both sides share get the suffixes _x and _y."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    left = left.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return left.join(right, key, "inner")


def pending(articles: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key was not handled yet."""
    return articles.join(done.select(key), key, "left_anti")


def with_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose column value is in a one-column key table."""
    return df.join(keys.toDF(column), column, "left_semi").select(*df.columns)


def replace_by_map(df: DataFrame, columns: Sequence[str], mapping: DataFrame) -> DataFrame:
    """Replace each value by its canonical name, single hop; unknown values stay."""
    order = df.columns
    for column in columns:
        lookup = mapping.select(F.col("alias").alias(column), F.col("canonical").alias("_canonical"))
        df = df.join(lookup, column, "left").withColumn(column, F.coalesce("_canonical", column)).drop("_canonical")
    return df.select(*order)


def first_types(entities: DataFrame, order: str = "seq") -> DataFrame:
    """First type seen per entity."""
    return keep_one(entities.select("entity", "entity_type", order), ["entity"], order).select("entity", "entity_type")


def add_entity_type(nodes: DataFrame, entities: DataFrame, node: str = "node", default: str = "unknown") -> DataFrame:
    types = first_types(entities).select(F.col("entity").alias(node), "entity_type")
    return nodes.join(types, node, "left").fillna({"entity_type": default})


def dominant_sentiment(edges: DataFrame) -> DataFrame:
    """Most frequent sentiment per ordered pair, the smallest value winning ties.

    Counting per (pair, sentiment) first keeps a hot pair's rows out of any single task.
    """
    counted = edges.filter("sentiment is not null").groupBy("source", "target", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("source", "target").agg(
        F.min_by("sentiment", F.struct(-F.col("n"), F.col("sentiment"))).alias("sentiment")
    )


def edge_sentiment(graph: DataFrame, edges: DataFrame) -> DataFrame:
    """Sentiment shown on each undirected edge, looked up in its stored direction only; ``neutral`` otherwise."""
    found = dominant_sentiment(edges).toDF("src", "dst", "sentiment")
    return graph.select("src", "dst").join(found, ["src", "dst"], "left").fillna({"sentiment": "neutral"})


def induced_subgraph(edges: DataFrame, nodes: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges whose two ends are both in the one-column node table."""
    nodes = cut(nodes)
    return with_keys(with_keys(edges, src, nodes), dst, nodes)
