"""Distributed running totals and exact order statistics.

An ungrouped ordered window would move every row to one task. Here rows are first reduced to one row per
distinct value and dealt to value ranges, as many as their number asks for, summed within each range in parallel, and
shifted by the total of the ranges before it. A heavily repeated value is a single row by then.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsweave.session import cut, scalar

#: distinct values summed by one task
ROWS_PER_RANGE = 100_000


def running_totals(values: DataFrame, order: str, sums: Sequence[str], descending: bool = False, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``cum_<c>`` for each summed column: the total up to and including the row.

    ``values`` must have one row per value of ``order``. Any cut points give the same totals; those of the shuffle by range
    balance the work. One row per range is summed at the end.
    """
    values = cut(values)
    ranges = max(1, math.ceil(values.count() / rows_per_range))
    ordering = F.col(order).desc() if descending else F.col(order)
    sliced = cut(values.repartitionByRange(ranges, ordering).withColumn("_slice", F.spark_partition_id()))
    offsets = sliced.groupBy("_slice").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("_slice", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    within = Window.partitionBy("_slice").orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumns({f"cum_{c}": F.sum(c).over(within) for c in sums})
        .join(F.broadcast(offsets), "_slice")  # one row per range
        .withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_{c}") for c in sums})
        .drop("_slice", *[f"_{c}" for c in sums])
    )


def exact_percentiles(df: DataFrame, column: str, shares: Sequence[float], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rows (share, value): percentiles by linear interpolation between neighbouring order statistics."""
    counts = (
        df.select(F.col(column).cast("double").alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    )
    running = running_totals(counts, "v", ["n"], rows_per_range=rows_per_range)
    total = scalar(running, F.max("cum_n"))
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    ranked = running.select("v", "n", "cum_n", wanted).withColumn("position", F.col("share") * (total - 1))

    def holds(rank):
        return (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))

    low, high = F.floor("position"), F.ceil("position")
    picked = (
        ranked.filter(holds(low) | holds(high))
        .groupBy("share", "position")
        .agg(F.max(F.when(holds(low), F.col("v"))).alias("a"), F.max(F.when(holds(high), F.col("v"))).alias("b"))
    )
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("position") - F.floor("position"))
    return picked.select("share", value.alias("value"))
