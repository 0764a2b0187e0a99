"""Exact meetings of near vectors: a tree of cells around pivot vectors, pruned by the triangle inequality.

A table of more than ``2 * rows_per_block`` rows is divided among pivots sampled from it, at most about ``FAN``; the cells
that come out are divided again down to ``rows_per_cell`` rows, so the number of cells follows from the number of rows, and
neither pivots nor sizes of a level pass the driver. What a division would give is counted before any guest is copied; it is
left where it does not at least halve the pairs to compare, or copies the guests oftener than blocks would. ``home`` rows lie in the cell of their nearest pivot. ``guests`` come with a ``limit`` and descend into every cell
that may hold a row within it; for a pivot at distance d, a cell is skipped if

* d is beyond the cell's radius plus the limit, or short of its least distance by more than the limit, or
* d is beyond the distance of the nearest pivot by more than twice the limit (rows of a cell are nearest to its pivot).

Cells of equal vectors, or of vectors that cannot be pruned, are dealt to blocks by hash instead, so no task holds more than
a bounded number of rows, and nothing is lost. As every guest is copied into each of these blocks, a large cell makes few and
wide ones; rows meet a slab at a time, so what a task computes and returns at once does not grow with the block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.session import cut

ROWS_PER_BLOCK = 2048
#: Rows that meet the pivots of a cell at once: a task holds their distances to at most about ``FAN`` pivots.
ROWS_PER_TASK = 512
#: A cell of more than ``WIDE_PARTS * ROWS_PER_BLOCK`` rows that is not divided makes that many blocks, or more of this many rows.
WIDE_PARTS = 8
ROWS_PER_WIDE_BLOCK = 1 << 15
#: Pairs compared at once.
PAIRS_AT_ONCE = ROWS_PER_BLOCK * ROWS_PER_BLOCK
#: Cells a guest may visit on average, or as many as there would be blocks.
VISITS = 32
FAN = 1024
ROUNDING = 1e-6
_HASH_RANGE = 1 << 30


def matrix(column: pd.Series | np.ndarray) -> np.ndarray:
    return column if isinstance(column, np.ndarray) else np.array(column.tolist(), dtype=np.float64)


def unit_rows(column: pd.Series) -> np.ndarray:
    """Rows of unit length; zero vectors stay zero."""
    rows = matrix(column)
    lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def angles(left: pd.Series, right: pd.Series) -> np.ndarray:
    return np.arccos(np.clip(unit_rows(left) @ unit_rows(right).T, -1.0, 1.0))


def euclidean(left: pd.Series, right: pd.Series | np.ndarray) -> np.ndarray:
    one, two = matrix(left), matrix(right)
    squared = (one * one).sum(1)[:, None] + (two * two).sum(1)[None, :] - 2.0 * (one @ two.T)
    return np.sqrt(np.maximum(squared, 0.0))


Metric = Callable[[pd.Series, pd.Series], np.ndarray]


def _parts(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(keys, parts): into how many parts of about ``size`` rows the rows of a key are dealt."""
    return cut(rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).alias("parts")))


def _dealt(rows: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")


def _repeated(rows: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(parts, keys).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")


def together(dealt: DataFrame, repeated: DataFrame, keys: list[str], size: int, use: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``use`` of parts of ``dealt`` with all rows of ``repeated`` of the same keys."""
    parts = _parts(dealt, keys, size)
    repeated = repeated.toDF(*repeated.columns)  # columns of its own, should both sides come from one frame
    left, right = _dealt(dealt, parts, keys).groupBy(*keys, "part"), _repeated(repeated, parts, keys).groupBy(*keys, "part")
    return left.cogroup(right).applyInPandas(use, schema)


def _blocks(rows_per_block: int) -> Column:
    """Into how many blocks a cell of ``n`` rows is dealt."""
    n = F.col("n")
    wide = F.when(n > WIDE_PARTS * ROWS_PER_BLOCK, F.least(n / WIDE_PARTS, F.lit(float(ROWS_PER_WIDE_BLOCK)))).otherwise(0.0)
    return F.ceil(n / F.greatest(F.lit(float(rows_per_block)), wide))


def _of(rows: DataFrame, *columns: str) -> str:
    return ", ".join(f"{c} {t}" for c, t in rows.dtypes if c in columns)


def _pivots(rows: DataFrame, wanted: DataFrame, level: int) -> DataFrame:
    """Rows by hash, as many per cell as wanted on average, and at least the one of the least hash."""
    draw = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(_HASH_RANGE))
    some = rows.join(wanted, "node").withColumn("draw", draw)
    first = some.groupBy("node").agg(F.min_by(F.struct("id", "embedding"), F.struct("draw", "id")).alias("p")).select("node", "p.id", "p.embedding")
    return cut(some.where(F.col("draw") < F.col("share") * _HASH_RANGE).select("node", "id", "embedding").unionByName(first).dropDuplicates(["id"]))


def cells(home: DataFrame, guests: DataFrame, metric: Metric, rows_per_block: int = ROWS_PER_BLOCK, rows_per_cell: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(home rows with their ``block``, guests with each ``block`` they have to meet).

    ``home``: id (unique), embedding; ``guests``: id, embedding, limit; other columns of ``home`` that guests share go along.
    Blocks hold about ``rows_per_block`` rows of ``home`` at most, or ``ROWS_PER_WIDE_BLOCK`` in large cells that are not divided.
    """
    rows_per_cell = rows_per_cell or max(4, rows_per_block // 256)
    kept = ["id", "embedding", *(c for c in home.columns if c in guests.columns and c not in ("id", "embedding", "limit"))]
    kind = _of(home, *kept)

    def place(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or pivots.empty:
            return pd.DataFrame()
        found = metric(rows["embedding"], pivots["embedding"])
        cell = found.argmin(axis=1)
        return rows[[*kept, "node"]].assign(cell=pivots["id"].to_numpy()[cell], far=found[np.arange(len(rows)), cell])

    def visits(rows: pd.DataFrame, pivots: pd.DataFrame) -> np.ndarray:
        found, limit = metric(rows["embedding"], pivots["embedding"]), rows["limit"].to_numpy()[:, None] + ROUNDING
        near = (found <= pivots["radius"].to_numpy() + limit) & (found >= pivots["least"].to_numpy() - limit)
        near &= found - found.min(axis=1, keepdims=True) <= 2 * limit
        return near

    def tally(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or pivots.empty:
            return pd.DataFrame()
        return pivots[["node"]].assign(cell=pivots["id"], g=visits(rows, pivots).sum(axis=0))

    def descend(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or pivots.empty:
            return pd.DataFrame()
        row, cell = np.nonzero(visits(rows, pivots))
        return rows[[*kept, "limit", "node"]].iloc[row].assign(cell=pivots["id"].to_numpy()[cell])

    own, visiting, total = home.select(*kept), guests.select(*kept, "limit"), home.count()
    if total <= 2 * rows_per_block:  # a single cell
        parts = max(1, math.ceil(total / rows_per_block))
        name = lambda part: F.concat_ws(":", F.lit(0), part)
        numbers = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        dealt = own.withColumn("block", name(F.pmod(F.xxhash64("id"), F.lit(parts))))
        return dealt, visiting.withColumn("part", numbers).select(*kept, "limit", name(F.col("part")).alias("block"))

    whole, asked = [], []

    def settle(rows: DataFrame, asking: DataFrame, nodes: DataFrame, level: int) -> None:
        """Cells that stay as they are: blocks, and their guests."""
        parts = nodes.select("node", _blocks(rows_per_block).alias("parts"))
        name = F.concat_ws(":", F.lit(level), "node", "part")
        whole.append(_dealt(rows, parts, ["node"]).select(*kept, name.alias("block")))
        asked.append(_repeated(asking, parts, ["node"]).select(*kept, "limit", name.alias("block")))

    root = F.lit(0).cast("bigint")
    own, visiting = cut(own.withColumn("node", root)), cut(visiting.withColumn("node", root))
    for level in count(1):
        sizes = cut(own.groupBy("node").agg(F.count(F.lit(1)).alias("n")))
        large = F.col("n") > 2 * rows_per_cell
        settle(own, visiting, sizes.where(~large), level)
        if sizes.where(large).isEmpty():
            return reduce(DataFrame.unionByName, whole), reduce(DataFrame.unionByName, asked)
        share = F.least(F.lit(float(FAN)), F.ceil(F.col("n") / rows_per_cell)) / F.col("n")
        divided = sizes.where(large).withColumn("share", share)
        own, visiting = (rows.join(divided.select("node"), "node", "left_semi") for rows in (own, visiting))
        pivots = _pivots(own, divided.select("node", "share"), level)
        placed = cut(together(own, pivots, ["node"], ROWS_PER_TASK, place, f"{kind}, node bigint, cell bigint, far double"))
        inside = placed.groupBy("node", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"), F.min("far").alias("least"))
        known = cut(pivots.withColumnRenamed("id", "cell").join(inside, ["node", "cell"]).withColumnRenamed("cell", "id"))
        # pairs to compare in each cell as it is, and in what would come out of it
        before = visiting.groupBy("node").agg(F.count(F.lit(1)).alias("g"))
        tallied = together(visiting, known, ["node"], ROWS_PER_TASK, tally, "node bigint, cell bigint, g bigint")
        after = tallied.join(known.select("node", F.col("id").alias("cell"), "n"), ["node", "cell"])
        after = after.groupBy("node").agg(F.sum(F.col("g") * F.col("n")).alias("after"), F.sum("g").alias("copies"))
        gain = divided.join(before, "node", "left").join(after, "node", "left").fillna(0, ["g", "after", "copies"])
        halved = F.col("after") <= 0.5 * F.col("n") * F.col("g")
        few = F.col("copies") <= F.col("g") * F.greatest(F.lit(VISITS), _blocks(rows_per_block))
        gain = cut(gain.select("node", "n", (halved & few).alias("good")))
        settle(own, visiting, gain.where("NOT good"), level)
        good = gain.where("good").select("node")
        own = placed.join(good, "node", "left_semi").select(*kept, F.col("cell").alias("node"))
        descending, known = (rows.join(good, "node", "left_semi") for rows in (visiting, known))
        descended = cut(together(descending, known, ["node"], ROWS_PER_TASK, descend, f"{kind}, limit double, node bigint, cell bigint"))
        visiting = descended.select(*kept, "limit", F.col("cell").alias("node"))


#: From the rows of a block to what they give for some guests.
Match = Callable[[pd.DataFrame], Callable[[pd.DataFrame], pd.DataFrame]]


def meet(pool: DataFrame, guests: DataFrame, match: Match, schema: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``match(pool)(guests)`` for every block, its guests dealt to tasks that hold as many of them as of the block, and met in slabs."""

    def use(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames), ignore_index=True)
        there, asking = rows[rows["home"]], rows[~rows["home"]]
        if there.empty or asking.empty:
            return
        found, slab = match(there), max(1, PAIRS_AT_ONCE // len(there))
        for begin in range(0, len(asking), slab):
            yield found(asking.iloc[begin : begin + slab])

    columns = [c for c in pool.columns if c in guests.columns]
    here = pool.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    asked = guests.groupBy("block").agg(F.count(F.lit(1)).alias("g"))
    parts = cut(asked.join(here, "block").select("block", F.ceil(F.col("g") / F.greatest(F.col("n"), F.lit(rows_per_block))).alias("parts")))
    dealt = _dealt(guests.select(*columns), parts, ["block"]).withColumn("home", F.lit(False))
    repeated = _repeated(pool.select(*columns), parts, ["block"]).withColumn("home", F.lit(True))
    return dealt.unionByName(repeated).groupBy("block", "part").applyInPandas(use, schema)


def compared(pool: DataFrame, guests: DataFrame) -> int:
    """Pairs of a guest and a home row that ``meet`` looks at."""
    sizes = pool.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    return guests.join(sizes, "block").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def constant_limit(rows: DataFrame, limit: float | Column) -> DataFrame:
    return rows.withColumn("limit", F.lit(limit).cast("double"))
