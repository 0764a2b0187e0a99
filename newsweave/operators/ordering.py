"""Order-dependent picks. Every pick names its order column; partition order is never relied on.

They are aggregates, not windows: rows of one hot key are reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.session import partitions

COPIES_PER_STEP = 4096


def keep_one(df: DataFrame, keys: Sequence[str], order: str = "seq", keep: str = "first") -> DataFrame:
    """The first or last row per key by the order column."""
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.col(order)).alias("_row"))
        .select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])
    )


def collapse_edges(edges: DataFrame, directed: bool = True, order: str = "seq") -> DataFrame:
    """One edge per ordered (or unordered) pair carrying the attributes of its last row."""
    attributes = [c for c in edges.columns if c not in ("source", "target")]
    if directed:
        src, dst = F.col("source"), F.col("target")
    else:
        src, dst = F.least("source", "target"), F.greatest("source", "target")
    return (
        edges.filter(F.col("source").isNotNull() & F.col("target").isNotNull())
        .groupBy(src.alias("src"), dst.alias("dst"))
        .agg(F.max_by(F.struct(*attributes), F.col(order)).alias("_row"))
        .select("src", "dst", "_row.*")
    )


def view_edge_dedupe(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Last row per (source, target, relationship)."""
    return keep_one(edges, ["source", "target", "relationship"], order, "last")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column; of strings the SHA-256 digests are compared and moved."""
    columns = [F.sha2(name, 256) if kind == "string" else F.col(name) for name, kind in df.dtypes]
    counts = df.groupBy(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every copy of each fully duplicated row.

    Copies are identical, so they are counted (partial counts before the shuffle) and written out again in
    bounded steps that are spread evenly; no task receives a whole group.
    """
    counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    steps = counts.withColumn("_step", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_STEP))))
    spread = steps.repartition(partitions(df.sparkSession))
    left = F.least(F.lit(COPIES_PER_STEP), F.col("_n") - F.col("_step") * COPIES_PER_STEP)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left.cast("bigint")))).select(*df.columns)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows under a total order."""
    return df.orderBy(*order).limit(n)
