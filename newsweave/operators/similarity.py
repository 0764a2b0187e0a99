"""Exact similarity join and nearest neighbours over vectors, on the tree of cells in ``cells``."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.operators.cells import ROWS_PER_BLOCK, angles, cells, constant_limit, euclidean, matrix, meet, unit_rows
from newsweave.session import cut

NO_PAIRS = {"a": "int64", "b": "int64", "cosine": "float64"}


def reach(threshold: float) -> float:
    """The angle of pairs at the threshold."""
    return math.pi if threshold < 0 else math.acos(min(threshold, 1.0))


def pairs_between(
    left: DataFrame, right: DataFrame, threshold: float, rows_per_block: int = ROWS_PER_BLOCK, ordered: bool = False, named: bool = False
) -> DataFrame:
    """All pairs (a, b, cosine) of a row of ``left`` and one of ``right`` (id, embedding each) with cosine above the threshold.

    With ``ordered`` only pairs with a < b; with ``named`` the rows have a name, and pairs too (left, right). The cells are
    those of ``right``.
    """
    columns = ["id", "embedding", *(["name"] if named else [])]
    left, right = left.select(*columns), right.select(*columns)
    pool, guests = cells(right, constant_limit(left, reach(threshold)), angles, rows_per_block)

    def multiply(there: pd.DataFrame) -> Callable[[pd.DataFrame], pd.DataFrame]:
        known, b = unit_rows(there["embedding"]).T, there["id"].to_numpy()

        def near(asking: pd.DataFrame) -> pd.DataFrame:
            cosines = unit_rows(asking["embedding"]) @ known
            a, at = asking["id"].to_numpy(), np.flatnonzero(cosines > threshold)
            i, j = np.divmod(at, len(b))
            if ordered:
                first = a[i] < b[j]
                at, i, j = at[first], i[first], j[first]
            pairs = pd.DataFrame({"a": a[i], "b": b[j], "cosine": cosines.ravel()[at]}).astype(NO_PAIRS)
            return pairs.assign(left=asking["name"].to_numpy()[i], right=there["name"].to_numpy()[j]) if named else pairs

        return near

    schema = "a bigint, b bigint, cosine double" + (", left string, right string" if named else "")
    return meet(pool, guests, multiply, schema, rows_per_block)


def pairs_above(vectors: DataFrame, threshold: float, rows_per_block: int = ROWS_PER_BLOCK, named: bool = False) -> DataFrame:
    """All pairs (a, b, cosine), a < b, of ``vectors`` (id, embedding) with cosine above the threshold."""
    return pairs_between(vectors, vectors, threshold, rows_per_block, ordered=True, named=named)


def similar_pairs(vectors: DataFrame, threshold: float, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """All pairs (left, right, left_seq, right_seq, cosine) with cosine above the threshold, left_seq < right_seq.

    ``vectors``: name, seq (unique), embedding. Names go with the vectors, since pairs are too many to be joined with them.
    """
    rows, names = vectors.select(F.col("seq").alias("id"), "embedding"), vectors.select(F.col("seq").alias("id"), "name")
    pairs = pairs_above(rows.join(names, "id"), threshold, rows_per_block, named=True)
    return pairs.select("left", "right", F.col("a").alias("left_seq"), F.col("b").alias("right_seq"), "cosine")


FOUND = "id bigint, neighbour bigint, distance double"


def _best(k: int):
    """The k nearest of the rows there for each row asking, ties to the lesser id."""

    def best(there: pd.DataFrame) -> Callable[[pd.DataFrame], pd.DataFrame]:
        there = there.sort_values("id")
        others, known = there["id"].to_numpy(), matrix(there["embedding"])

        def nearest_of(asking: pd.DataFrame) -> pd.DataFrame:
            ids = asking["id"].to_numpy()
            found = euclidean(asking["embedding"], known)
            found[ids[:, None] == others[None, :]] = np.inf
            order = np.argsort(found, axis=1, kind="stable")[:, :k]
            rows = pd.DataFrame({"id": np.repeat(ids, order.shape[1]), "neighbour": others[order].ravel(), "distance": np.take_along_axis(found, order, 1).ravel()})
            return rows[np.isfinite(rows["distance"])]

        return nearest_of

    return best


def neighbourhoods(vectors: DataFrame, k: int, rows_per_block: int = ROWS_PER_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Blocks of ``vectors`` and the blocks each row has to meet for its k nearest others.

    A row's k-th distance within its own block bounds the radius it has to look in; with fewer rows there it looks everywhere.
    """
    nowhere = constant_limit(vectors, 0.0).limit(0)
    pool = cut(cells(vectors, nowhere, euclidean, rows_per_block)[0])
    near = meet(pool, pool, _best(k), FOUND, rows_per_block)
    bound = near.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("limit"))
    everywhere = F.coalesce("limit", F.lit(float("inf")))
    guests = cut(vectors.select("id", "embedding").join(bound, "id", "left").select("id", "embedding", everywhere.alias("limit")))
    return cells(vectors, guests, euclidean, rows_per_block)


def nearest(vectors: DataFrame, k: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The k nearest other rows by Euclidean distance, exact, ties to the lesser id: (id, neighbour, distance).

    ``vectors``: id (unique), embedding.
    """
    pool, guests = neighbourhoods(vectors, k, rows_per_block)
    met = meet(pool, guests, _best(k), FOUND, rows_per_block)
    # k rows per block a row met
    ranked = met.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("distance", "neighbour"))), 1, k).alias("best"))
    return ranked.select("id", F.explode("best").alias("b")).select("id", "b.neighbour", "b.distance")
