"""Profiling aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.operators.distribution import exact_percentiles
from newsweave.session import cut, scalar


def column_counts(df: DataFrame) -> DataFrame:
    """Non-null count per column."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], list(df.columns), "column", "n")


def presence(column: str) -> Column:
    """An empty text where the column is filled, null where it is not: all that counting nulls needs to move."""
    return F.when(F.col(column).isNotNull(), F.lit(""))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).unpivot([], list(df.columns), "column", "n")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def value_ratios(df: DataFrame, column: str) -> DataFrame:
    """Frequency and share of the non-null rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.col("n") / scalar(counts, F.sum("n")))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n"))


def domain(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(F.col(column).alias("value")).filter("value is not null").distinct().orderBy("value")


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean of the non-null values per non-null key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias("mean"))


def share_of_all(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Flag sums over relevant rows divided by the count of all rows."""
    relevant = F.col("relevance_text") == 1
    shares = [(F.coalesce(F.sum(F.when(relevant, F.col(f))), F.lit(0)) / F.count(F.lit(1))).alias(f) for f in flags]
    return df.agg(*shares).unpivot([], list(flags), "flag", "ratio")


def histogram(df: DataFrame, column: str, width: int) -> DataFrame:
    """Counts per bin of fixed width from 0 to the maximum; bins are half-open, the last one closed."""
    known = df.select(F.col(column).alias("v")).filter("v is not null")
    # one row per open bin is all that moves; the closed end is folded in afterwards
    counted = cut(known.groupBy(F.floor(F.col("v") / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")))
    bins = F.greatest(F.ceil(F.max("top") / width), F.lit(1))
    slots = counted.agg(bins.alias("bins"), F.max("top").alias("top")).filter("top is not null")
    empty = slots.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)).alias("bin"))
    folded = counted.groupBy(F.least("bin", scalar(counted, bins) - 1).alias("bin")).agg(F.sum("n").alias("n"))
    return empty.join(folded, "bin", "left").select(
        (F.col("bin") * width).alias("bin_start"),
        ((F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def min_max_scale(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Linear scaling to [low, high]; a constant column maps to low."""
    smallest = scalar(df, F.min(column))
    largest = scalar(df, F.max(column))
    span = largest - smallest
    share = F.when(span == 0, F.lit(0.0)).otherwise((F.col(column) - smallest) / span)
    return df.withColumn("scaled", low + share * (high - low))


def percentile_threshold(df: DataFrame, column: str, share: float) -> DataFrame:
    """Exact percentile with linear interpolation, as one row."""
    return exact_percentiles(df, column, [share]).select(F.col("value").alias("threshold"))


def value_types(df: DataFrame, column: str) -> DataFrame:
    """Frequency of the runtime type of nested cells held as JSON text."""
    parsed = F.try_parse_json(column)
    kind = F.regexp_extract(F.schema_of_variant(parsed), r"^([A-Z]+)", 1)
    return df.groupBy(F.lower(F.coalesce(kind, F.lit("unreadable"))).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def clusters_by_canonical(mapping: DataFrame, names_per_part: int = 10_000) -> DataFrame:
    """Alias lists per canonical name, more than one name only, largest first.

    A cluster of any size is listed whole: one with more than ``names_per_part`` names is spread over
    several rows numbered by ``part``, so that no cell and no task holds an unbounded list.
    """
    sizes = cut(
        mapping.groupBy("canonical").agg(F.count(F.lit(1)).alias("number_of_names_in_cluster")).filter("number_of_names_in_cluster > 1")
    )
    parts = F.ceil(F.col("number_of_names_in_cluster") / names_per_part)
    grouped = (
        mapping.join(sizes, "canonical")
        .withColumn("part", F.pmod(F.xxhash64("alias"), parts))
        .groupBy("canonical", "part", "number_of_names_in_cluster")
        .agg(F.sort_array(F.collect_list("alias")).alias("aliases"))
    )
    return grouped.select("canonical", "part", "aliases", "number_of_names_in_cluster").orderBy(
        F.desc("number_of_names_in_cluster"), "canonical", "part"
    )


def cluster_sizes(mapping: DataFrame) -> DataFrame:
    """How many clusters have each size above one; sizes are counted without building the lists."""
    sizes = mapping.groupBy("canonical").agg(F.count(F.lit(1)).alias("number_of_names_in_cluster"))
    return (
        sizes.filter("number_of_names_in_cluster > 1")
        .groupBy("number_of_names_in_cluster")
        .agg(F.count(F.lit(1)).alias("number_of_clusters"))
        .orderBy("number_of_names_in_cluster")
    )


def resolution_totals(mapping: DataFrame) -> DataFrame:
    """(names, canonicals, merged): how many names there are, into how many they went, and how many were not their own."""
    merged = F.count_if(F.col("alias") != F.col("canonical"))
    return mapping.agg(F.count(F.lit(1)).alias("names"), F.count_distinct("canonical").alias("canonicals"), merged.alias("merged"))
