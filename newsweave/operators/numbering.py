"""Consecutive numbers over a whole table, without a window over all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.session import cut

#: ``monotonically_increasing_id`` keeps the partition above these bits and the place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, name: str, *order: Column, start: int = 0) -> DataFrame:
    """``df`` with ``name``, counting rows from ``start`` in the given order.

    Rows are dealt to ranges of the order and sorted there, one shuffle; a row's number is its place in its range
    plus the rows of all ranges before, and only one total per range passes the driver. End the order with a column
    that tells rows apart, so that a hot value is divided over ranges and reruns agree.
    """
    place = "_" * max(map(len, df.columns)) + "place"  # a name no column has
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()))
    part = F.shiftright(place, _PLACE_BITS)
    sizes = {r["part"]: r["n"] for r in ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = sorted(sizes)
    before = accumulate((sizes[p] for p in parts), initial=start)  # one longer than parts
    shifts = df.sparkSession.createDataFrame(list(zip(parts, before, strict=False)), f"`{place}_part` long, `{place}_before` long")
    # one row per range: bounded by the number of partitions
    found = ranged.join(F.broadcast(shifts), part == F.col(f"{place}_part"), "left")
    within = F.col(place).bitwiseAND((1 << _PLACE_BITS) - 1)
    return found.select(*[exact(c) for c in df.columns], (F.col(f"{place}_before") + within).alias(name))


def exact(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")
