"""PageRank by joins and aggregates, betweenness by searches in memory or by tiles.

Hub nodes in PageRank: the edges of one node are divided into parts of bounded size (``part``), and the node's own row is
repeated once per part, so that no join partition holds all the edges of a hub. A node of ordinary degree
has a single part. Sums per target are combined before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.operators.graph import degree_centrality
from newsweave.operators.numbering import numbered
from newsweave.operators.paths import dependencies
from newsweave.session import cut, discarding, partitions

EDGES_PER_PART = 100_000
STATE_ROWS = 200_000_000
#: Arcs of a graph that workers hold whole (four bytes each), and entries of a batch whose state stays in its tasks.
ARCS_HELD = 100_000_000
HELD_STATE_ROWS = 10_000_000_000
#: Nodes and roots of a tile of the betweenness state, entries of one group, and arcs added up at once.
NODES_PER_TILE = 4096
ROOTS_PER_TILE = 128
COLUMN_ENTRIES = 4_000_000
ARCS_AT_ONCE = 8192


def both_ways(graph: DataFrame) -> DataFrame:
    """Every undirected edge as two arcs, a self loop as one."""
    arcs = F.when(F.col("src") == F.col("dst"), F.array(F.struct("src", "dst", "weight"))).otherwise(
        F.array(
            F.struct("src", "dst", "weight"),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"),
        )
    )
    return graph.select(F.explode(arcs).alias("arc")).select("arc.*")


def spread_arcs(arcs: DataFrame, edges_per_part: int = EDGES_PER_PART) -> tuple[DataFrame, DataFrame]:
    """(arcs with ``part``, nodes with ``parts`` and their outgoing weight)."""
    ends = arcs.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.col("weight").cast("double").alias("w"), F.lit(1).alias("arcs")),
                F.struct(F.col("dst").alias("node"), F.lit(0.0).alias("w"), F.lit(0).alias("arcs")),
            )
        ).alias("e")
    ).select("e.*")
    parts = F.greatest(F.ceil(F.sum("arcs") / edges_per_part), F.lit(1))
    nodes = cut(ends.groupBy("node").agg(F.sum("w").alias("out_weight"), parts.alias("parts")))
    sized = nodes.select(F.col("node").alias("src"), "out_weight", "parts")
    placed = arcs.join(sized, "src").withColumn("part", F.pmod(F.xxhash64("dst"), "parts"))
    return placed, nodes


def repeat_per_part(df: DataFrame) -> DataFrame:
    return df.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))


def pagerank(
    graph: DataFrame,
    alpha: float = 0.85,
    tol: float = 1e-6,
    max_iter: int = 100,
    directed: bool = False,
    edges_per_part: int = EDGES_PER_PART,
) -> DataFrame:
    """Weighted PageRank with uniform teleport and uniformly spread dangling mass.

    Stops when the summed change is below n*tol, and fails after ``max_iter`` rounds without that.
    """
    spark = graph.sparkSession
    graph = cut(graph.select("src", "dst", "weight"))
    arcs = graph if directed else both_ways(graph)
    placed, nodes = spread_arcs(arcs, edges_per_part)
    # The arcs are shuffled once; each round only moves one row per node to them. A lost cached block is
    # recomputed from its inputs. Each node also has an arc of no weight to itself that carries its old rank
    # along, so a round reads the ranks once and the plan grows by a constant step.
    own = nodes.select(
        "node",
        F.lit(0).cast("bigint").alias("part"),
        F.col("node").alias("dst"),
        F.lit(0.0).alias("share"),
        "parts",
        (F.col("out_weight") == 0).alias("dangling"),
    )
    links = (
        placed.select(
            F.col("src").alias("node"),
            "part",
            "dst",
            (F.col("weight") / F.col("out_weight")).alias("share"),
            F.lit(None).cast("bigint").alias("parts"),
            F.lit(None).cast("boolean").alias("dangling"),
        )
        .unionByName(own)
        .repartition(partitions(spark), "node", "part")
        .sortWithinPartitions("node", "part")
        .persist()
    )
    try:
        # filled now: only a filled cache tells the planner of the rounds how it is partitioned and sorted
        links.count()
        n = nodes.count()
        if n == 0:
            return nodes.select("node", F.lit(0.0).alias("pagerank"))
        dangling = not nodes.filter("out_weight = 0").isEmpty()
        ranks = nodes.select("node", "parts", (F.col("out_weight") == 0).alias("dangling"), F.lit(1.0 / n).alias("rank"))
        for _ in range(max_iter):
            lost = ranks.filter("dangling").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0] if dangling else 0.0
            base = (1.0 - alpha) / n + alpha * lost / n
            ranks = cut(
                repeat_per_part(ranks.select("node", "parts", "rank"))
                .drop("parts")
                .join(links, ["node", "part"])
                .groupBy(F.col("dst").alias("node"))
                .agg(
                    F.sum(F.col("rank") * F.col("share")).alias("mass"),
                    F.max("parts").alias("parts"),
                    F.max("dangling").alias("dangling"),
                    F.max(F.when(F.col("parts").isNotNull(), F.col("rank"))).alias("old"),
                )
                .select("node", "parts", "dangling", (F.lit(alpha) * F.col("mass") + F.lit(base)).alias("rank"), "old")
            )
            change = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            if change < n * tol:
                break
        else:
            raise RuntimeError(f"no convergence within {max_iter} rounds")
        return ranks.select("node", F.col("rank").alias("pagerank"))
    finally:
        links.unpersist()


def betweenness(graph: DataFrame, state_rows: int | None = None, edges_per_part: int = EDGES_PER_PART) -> DataFrame:
    """Normalised shortest-path betweenness of an undirected, unweighted graph, all roots, exact.

    Level-synchronous search of all roots, then dependency sums from the deepest level back. The state has one entry per
    reached (root, node), so a root has at most one per node; the roots go in batches whose state is at most about
    ``state_rows``. A batch leaves one row per node, and its tables are deleted.

    Nodes are numbered. Up to ``ARCS_HELD`` arcs are sent to every worker, and a task searches from its roots in arrays; it
    gives one sum per node, so neither state nor arcs are shuffled.

    Beyond that a level is a table of tiles: the entries of ``NODES_PER_TILE`` nodes and some roots as arrays. Arcs
    are grouped by the tiles of their ends, in lists of about ``edges_per_part``, and added up array-wise, all the roots of
    a tile at a time; a group holds the entries of all nodes for its roots, which are as few as ``COLUMN_ENTRIES`` asks for.
    """
    spark = graph.sparkSession
    with discarding(spark) as keep:
        graph = cut(graph.select("src", "dst"))
        simple = graph.filter("src <> dst").select("src", "dst", F.lit(1).alias("weight"))
        nodes = cut(numbered(graph.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), "at", F.asc("node")))
        n = nodes.count()
        held = _held(simple, nodes, n) if 2 * simple.count() <= ARCS_HELD else None
        lists = _arc_lists(both_ways(simple), nodes, edges_per_part) if held is None else None
        batches = max(1, math.ceil(n * n / (state_rows or (STATE_ROWS if held is None else HELD_STATE_ROWS))))
        roots_per_tile = max(1, min(ROOTS_PER_TILE, COLUMN_ENTRIES // max(n, 1)))
        totals = []
        try:
            for batch in range(batches):
                with discarding(spark) as keep_total:
                    roots = nodes.filter(F.col("at") % batches == batch).select("at", F.expr(f"at div {batches}").alias("place"))
                    found = _dependencies(roots, lists if held is None else held, roots_per_tile)
                    totals.append(keep_total(found.groupBy("at").agg(F.sum("delta").alias("delta"))))
        finally:
            if held is not None:
                held.destroy()
        partial = reduce(DataFrame.unionByName, totals)
        scale = 1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0
        summed = partial.groupBy("at").agg(F.sum("delta").alias("delta"))
        return keep(nodes.join(summed, "at", "left").select("node", (F.coalesce("delta", F.lit(0.0)) * scale).alias("betweenness")))


def _held(simple: DataFrame, nodes: DataFrame, n: int) -> Broadcast:
    """The arcs as arrays for every worker (see ``paths``), filled on the driver a partition at a time."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ends = [np.asarray(found, np.int32) for found in frame["ends"]]
            sizes = np.array([len(found) for found in ends], np.int64)
            yield pd.DataFrame([{"node": frame["node"].to_numpy(np.int64).tobytes(), "size": sizes.tobytes(), "ends": np.concatenate(ends).tobytes()}])

    numbers = simple.join(nodes.toDF("src", "one"), "src").join(nodes.toDF("dst", "other"), "dst")
    pair = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).cast("int").alias("end"))
    arcs = numbers.select(F.explode(F.array(pair("one", "other"), pair("other", "one"))).alias("arc")).select("arc.*")
    ends = arcs.groupBy("node").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    packed = cut(ends.mapInPandas(pack, "node binary, size binary, ends binary"))
    sizes = np.zeros(n + 1, np.int64)
    for row in packed.select("node", "size").toLocalIterator():
        sizes[np.frombuffer(row["node"], np.int64) + 1] = np.frombuffer(row["size"], np.int64)
    first = np.cumsum(sizes)
    filled = np.empty(first[-1], np.int32)
    for row in packed.toLocalIterator():
        node, size = np.frombuffer(row["node"], np.int64), np.frombuffer(row["size"], np.int64)
        place = np.repeat(first[node] - (np.cumsum(size) - size), size)
        filled[place + np.arange(len(place))] = np.frombuffer(row["ends"], np.int32)
    return simple.sparkSession.sparkContext.broadcast((first, filled))


def _arc_lists(arcs: DataFrame, nodes: DataFrame, edges_per_part: int) -> DataFrame:
    """(origin, part, src, dst): places within their tiles of the ends of arcs from the tile ``origin`` to the tile ``part``."""
    ends = arcs.join(nodes.toDF("src", "from"), "src").join(nodes.toDF("dst", "to"), "dst")
    tile, place = (lambda c: F.floor(F.col(c) / NODES_PER_TILE)), (lambda c: (F.col(c) % NODES_PER_TILE).cast("int"))
    ends = cut(ends.select(tile("from").alias("origin"), tile("to").alias("part"), place("from").alias("src"), place("to").alias("dst")))
    lists = ends.groupBy("origin", "part").agg(F.ceil(F.count(F.lit(1)) / edges_per_part).alias("lists"))
    dealt = ends.join(cut(lists), ["origin", "part"]).withColumn("list", F.pmod(F.xxhash64("src", "dst"), "lists"))
    ordered = F.sort_array(F.collect_list(F.struct("dst", "src")))
    found = dealt.groupBy("origin", "part", "list").agg(ordered.alias("arcs"))
    return cut(found.select("origin", "part", F.col("arcs.src").alias("src"), F.col("arcs.dst").alias("dst")))


_TILE = "part bigint, block bigint, node binary, root binary, value binary"


def _entries(tile) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(tile.node, np.uint16), np.frombuffer(tile.root, np.uint16), np.frombuffer(tile.value, np.float64)


def _tile(key: tuple, node: np.ndarray, root: np.ndarray, value: np.ndarray, **more) -> pd.DataFrame:
    row = {"part": key[0], "block": key[1], "node": node.astype(np.uint16).tobytes(), "root": root.astype(np.uint16).tobytes(), "value": value.tobytes()}
    return pd.DataFrame([row | more])


def _arriving(asking: pd.DataFrame, lists: pd.DataFrame, roots_per_tile: int, invert: bool) -> np.ndarray:
    """Sums over the arcs, for every node of a tile and root of a block, of the values where the arcs begin."""
    sums, by_origin = np.zeros((NODES_PER_TILE, roots_per_tile)), dict(list(lists.groupby("origin")))
    for tile in asking.itertuples():
        if tile.origin not in by_origin:
            continue
        node, root, value = _entries(tile)
        values = np.zeros((NODES_PER_TILE, roots_per_tile))
        values[node, root] = 1.0 / value if invert else value
        active = np.zeros(NODES_PER_TILE, dtype=bool)
        active[node] = True
        for arcs in by_origin[tile.origin].itertuples():
            used = active[arcs.src]
            src, dst = arcs.src[used], arcs.dst[used]
            for first in range(0, len(src), ARCS_AT_ONCE):
                some = dst[first : first + ARCS_AT_ONCE]
                starts = np.flatnonzero(np.diff(some, prepend=-1))  # sorted by dst
                sums[some[starts]] += np.add.reduceat(values[src[first : first + ARCS_AT_ONCE]], starts, axis=0)
    return sums


def _step(asking: DataFrame, known: DataFrame, lists: DataFrame, blocks: DataFrame, use: Callable, schema: str) -> DataFrame:
    """``use(key, asking tiles, known tiles, arc lists)`` for the nodes of a tile and the roots of a block."""

    def both(key: tuple, tiles: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
        asked = tiles["origin"] >= 0
        return use(key, tiles[asked], tiles[~asked], arcs)

    reach = lists.select("origin", "part").distinct()
    asked = asking.select(F.col("part").alias("origin"), "block", "node", "root", "value").join(reach, "origin")
    columns = ["origin", "part", "block", "node", "root", "value"]
    tiles = asked.select(*columns).unionByName(known.withColumn("origin", F.lit(-1).cast("bigint")).select(*columns))
    arcs = lists.crossJoin(F.broadcast(blocks)).toDF(*lists.columns, "block")  # columns of its own, as both sides come from the lists
    return tiles.groupBy("part", "block").cogroup(arcs.groupBy("part", "block")).applyInPandas(both, schema)


def _searched(roots: DataFrame, held: Broadcast, roots_per_tile: int) -> DataFrame:
    """Sums of the dependencies of the given roots (at, place): (at, delta), a row per task and node."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, ends = held.value
        sums = np.zeros(len(first) - 1)
        for frame in frames:
            for some in frame["root"]:
                sums += dependencies(first, ends, np.asarray(some, np.int64))
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"at": at, "delta": sums[at]})

    block = F.floor(F.col("place") / roots_per_tile).alias("block")
    tiles = cut(roots.groupBy(block).agg(F.sort_array(F.collect_list("at")).alias("root")))
    tasks = 3 * roots.sparkSession.sparkContext.defaultParallelism  # equal work each, and one row per node
    return tiles.repartition(tasks).mapInPandas(search, "at bigint, delta double")


def _dependencies(roots: DataFrame, arcs: Broadcast | DataFrame, roots_per_tile: int) -> DataFrame:
    """Sums of the dependencies of the given roots (at, place): (at, delta), by arcs held whole or by lists of them."""
    return (_searched if isinstance(arcs, Broadcast) else _tiled)(roots, arcs, roots_per_tile)


def _tiled(roots: DataFrame, lists: DataFrame, roots_per_tile: int) -> DataFrame:
    """Sums of the dependencies of the given roots (at, place): (at, delta), a row per tile and node."""

    def begin(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _tile(key, rows["at"].to_numpy() % NODES_PER_TILE, rows["place"].to_numpy() % roots_per_tile, np.ones(len(rows)))

    def further(key: tuple, asking: pd.DataFrame, known: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or arcs.empty:
            return pd.DataFrame()
        sums = _arriving(asking, arcs, roots_per_tile, False)
        for tile in known.itertuples():
            sums[_entries(tile)[:2]] = 0.0
        node, root = np.nonzero(sums)
        return _tile(key, node, root, sums[node, root]) if len(node) else pd.DataFrame()

    def back(invert: bool):
        def nearer(key: tuple, asking: pd.DataFrame, upper: pd.DataFrame, arcs: pd.DataFrame) -> pd.DataFrame:
            if upper.empty:
                return pd.DataFrame()
            arriving = _arriving(asking, arcs, roots_per_tile, invert)
            node, root, sigma = _entries(next(upper.itertuples()))
            delta = sigma * arriving[node, root]
            return _tile(key, node, root, (1.0 + delta) / sigma, sums=np.bincount(node, delta, NODES_PER_TILE))

        return nearer

    placed = roots.withColumns({"part": F.floor(F.col("at") / NODES_PER_TILE), "block": F.floor(F.col("place") / roots_per_tile)})
    levels = [cut(placed.groupBy("part", "block").applyInPandas(begin, _TILE))]
    blocks = cut(levels[0].select("block").distinct())
    # Neighbours of a level lie in it, in the level before or in the next, so two levels are all that need checking.
    while True:
        known = reduce(DataFrame.unionByName, levels[-2:])
        level = cut(_step(levels[-1], known, lists, blocks, further, _TILE))
        if level.isEmpty():
            break
        levels.append(level)
    found = []
    below = levels[-1]
    for upper in reversed(levels[1:-1]):
        below = cut(_step(below, upper, lists, blocks, back(not found), f"{_TILE}, sums array<double>"))
        found.append(below.select("part", F.posexplode("sums").alias("node", "delta")))
    if not found:
        return roots.select("at", F.lit(0.0).alias("delta")).limit(0)
    total = reduce(DataFrame.unionByName, found).filter("delta <> 0")
    return total.select((F.col("part") * NODES_PER_TILE + F.col("node")).alias("at"), "delta")


def node_metrics(graph: DataFrame) -> DataFrame:
    """entity, degree, pagerank, betweenness of an undirected weighted graph."""
    with discarding(graph.sparkSession) as keep:
        graph = cut(graph.select("src", "dst", "weight"))
        degrees = degree_centrality(graph).select("node", F.col("degree_centrality").alias("degree"))
        with discarding(graph.sparkSession) as keep_ranks:
            ranks = keep_ranks(pagerank(graph))
        brokers = betweenness(graph)
        return keep(degrees.join(ranks, "node").join(brokers, "node").withColumnRenamed("node", "entity"))


def top_brokers(metrics: DataFrame, n: int = 5) -> DataFrame:
    return metrics.orderBy(F.desc("betweenness"), "entity").limit(n)
