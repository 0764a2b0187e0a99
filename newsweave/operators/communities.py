"""Modularity and Louvain-style communities.

Works on the symmetric weight table (src, dst, weight) holding both directions of each edge and twice the
weight of a self loop, so that row sums are weighted degrees and contraction is a plain grouped sum.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.operators.numbering import numbered
from newsweave.session import cut, scalar

#: A pass over the nodes, or a level, that raises modularity by less than this is the last one. Every other raises it by as
#: much, and modularity is at most 1, so the loops end.
TOLERANCE = 1e-4

#: Arcs of a node beyond which its links are added up by all tasks, not by the one that holds the node.
HUB_ARCS = 1_000_000
#: Arcs a task of a round holds.
ARCS_PER_TASK = 500_000


def symmetric(graph: DataFrame) -> DataFrame:
    loop = F.array(F.struct("src", "dst", (2 * F.col("weight")).cast("double").alias("weight")))
    pair = F.array(
        F.struct("src", "dst", F.col("weight").cast("double").alias("weight")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("weight").cast("double").alias("weight")),
    )
    return graph.select(F.explode(F.when(F.col("src") == F.col("dst"), loop).otherwise(pair)).alias("a")).select("a.*")


def modularity(graph: DataFrame, communities: DataFrame, resolution: float = 1.0) -> DataFrame:
    """Weighted modularity of a partition (node, community), as one row."""
    return _modularity(_by_community(symmetric(graph), cut(communities)), resolution)


def _by_community(arcs: DataFrame, members: DataFrame) -> DataFrame:
    """Weights between communities; ``members`` is a written table, so the arcs of a hub can be split."""
    source = members.select(F.col("node").alias("src"), F.col("community").alias("a"))
    target = members.select(F.col("node").alias("dst"), F.col("community").alias("b"))
    return (
        arcs.join(source, "src").join(target, "dst").groupBy("a", "b").agg(F.sum("weight").alias("weight"))
    ).select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight")


def _modularity(between: DataFrame, resolution: float) -> DataFrame:
    inside = F.sum(F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(0.0))
    per = between.groupBy("src").agg(inside.alias("inside"), F.sum("weight").alias("total"))
    whole = scalar(per, F.sum("total"))
    share = F.col("total") / whole
    return per.agg(F.coalesce(F.sum(F.col("inside") / whole - resolution * share * share), F.lit(0.0)).alias("modularity"))


def communities(graph: DataFrame, resolution: float = 1.0, tolerance: float = TOLERANCE) -> DataFrame:
    """Communities (node, community) by local moving and contraction; a community is named after its smallest node.

    Deterministic: in each round a hash-chosen half of the nodes moves at once, to the neighbouring community
    of best gain, ties going to staying and then to the smallest name. After the first pass only nodes next to one that
    moved are looked at. Passes that lower modularity are undone. Before contraction a community that its moves have torn
    apart is divided into its connected pieces, which never lowers modularity, so every community is connected.
    The rounds work on numbers in the order of the names.
    """
    pairs = cut(graph.select("src", "dst", "weight"))
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("name")).distinct()
    labels = cut(numbered(ends.filter("name is not null"), "node", F.asc("name")))
    source, target = labels.toDF("src", "_src"), labels.toDF("dst", "_dst")
    coded = pairs.join(source, "src", "left").join(target, "dst", "left").select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "weight")
    arcs = cut(symmetric(coded).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    whole = arcs.agg(F.sum("weight")).first()[0]
    if not whole:
        return cut(ends.select(F.col("name").alias("node"), F.col("name").alias("community")))
    members = labels.select("node", F.col("node").alias("community"))
    best = _modularity(arcs, resolution).first()[0]
    while True:
        moved = _local_moves(arcs, labels, best, whole, resolution, tolerance)
        if moved is None:
            break
        moved = connected_pieces(arcs, moved)
        step = moved.select(F.col("node").alias("community"), F.col("community").alias("_next"))
        members = cut(members.join(step, "community").select("node", F.col("_next").alias("community")))
        arcs = cut(_by_community(arcs, moved))
        score = _modularity(arcs, resolution).first()[0]
        gained, best = score - best, score
        if gained < tolerance:
            break
    # name each community after its smallest node
    least = cut(members.groupBy("community").agg(F.min("node").alias("_least")))
    found = cut(members.join(least, "community").select("node", "_least"))
    titles = labels.select(F.col("node").alias("_least"), F.col("name").alias("community"))
    return cut(found.join(labels, "node").join(titles, "_least").select(F.col("name").alias("node"), "community"))


def connected_pieces(arcs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, community) with each community divided into its connected pieces, named after their smallest nodes.

    Every node takes the least name among its neighbours within the community, then the name of the node so named, until
    nothing changes: names spread twice as far with each round.
    """
    home = cut(members)
    inner = arcs.filter("src <> dst").select("src", "dst")
    inner = inner.join(home.select(F.col("node").alias("src"), F.col("community").alias("a")), "src")
    inner = cut(inner.join(home.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst").filter("a = b").select("src", "dst"))
    names = cut(home.select("node", F.col("node").alias("name")))
    while True:
        near = inner.join(names.select(F.col("node").alias("dst"), "name"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("name").alias("near"))
        least = cut(names.join(near, "node", "left").select("node", F.col("name").alias("old"), F.least("name", "near").alias("name")))
        ahead = least.select(F.col("node").alias("name"), F.col("name").alias("further"))
        found = cut(least.join(ahead, "name").select("node", "old", F.col("further").alias("name")))
        if found.filter("name <> old").isEmpty():
            return found.select("node", F.col("name").alias("community"))
        names = found.select("node", "name")


def alone(arcs: DataFrame) -> DataFrame:
    """(node, k, community): every node in a community of its own, with its weighted degree."""
    return arcs.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k")).withColumn("community", F.col("node"))


class _Arcs:
    """The arcs between the nodes of a level, shuffled by ``src`` once into a cache; those of hubs are kept apart, evenly dealt.

    The rounds of a level then look up and add up without moving arcs while the tables of its nodes are small enough to be
    broadcast. A lost cached block is recomputed from written tables.
    """

    def __init__(self, arcs: DataFrame, hub_arcs: int | None = None):
        hub_arcs = hub_arcs or HUB_ARCS
        between = arcs.filter("src <> dst")
        degrees = cut(between.groupBy("src").agg(F.count(F.lit(1)).alias("n")))
        large = degrees.filter(F.col("n") > hub_arcs).select("src")
        self.hubs = None if large.isEmpty() else cut(between.join(large, "src", "left_semi"))
        plain = between if self.hubs is None else between.join(large, "src", "left_anti")
        rows, cores = degrees.agg(F.sum("n")).first()[0] or 0, arcs.sparkSession.sparkContext.defaultParallelism
        tasks = max(1, min(cores, rows // 10_000), rows // ARCS_PER_TASK)
        self.plain = plain.select("src", "dst", "weight").repartition(tasks, "src").persist()
        self.plain.count()  # filled now: only a filled cache tells the planner how it is partitioned

    def _each(self, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return use(self.plain) if self.hubs is None else use(self.plain).unionByName(use(self.hubs))

    def beside(self, changed: DataFrame) -> DataFrame:
        """(node): the changed nodes and their neighbours."""
        near = self._each(lambda arcs: arcs.join(changed.toDF("dst"), "dst", "left_semi").select(F.col("src").alias("node")).distinct())
        return changed.unionByName(near).distinct()

    def links(self, movers: DataFrame, state: DataFrame) -> DataFrame:
        """(node, k, own, community, w): weights of ``movers`` (node, k, own) to the communities next to them."""
        seen = state.select(F.col("node").alias("dst"), "community")
        asking = movers.withColumnRenamed("node", "src")
        return self._each(
            lambda arcs: arcs.join(asking, "src").join(seen, "dst").groupBy(F.col("src").alias("node"), "k", "own", "community").agg(F.sum("weight").alias("w"))
        )

    def inside(self, state: DataFrame) -> DataFrame:
        """(community, inside): weights of the arcs within communities, loops left out."""
        a = state.select(F.col("node").alias("src"), "community")
        b = state.select(F.col("node").alias("dst"), F.col("community").alias("other"))
        same = self._each(lambda arcs: arcs.join(a, "src").join(b, "dst").filter("community = other").select("community", "weight"))
        return same.groupBy("community").agg(F.sum("weight").alias("inside"))

    def free(self) -> None:
        self.plain.unpersist()


def _reached(arcs: _Arcs, degrees: DataFrame, state: DataFrame, whole: float | None, resolution: float) -> float:
    """Modularity of ``state`` (node, k, community); ``degrees``: node, total, loop, and ``whole`` the sum of the totals."""
    per = state.join(degrees, "node").groupBy("community").agg(F.sum("total").alias("total"), F.sum("loop").alias("loop"))
    share = F.col("total") / F.lit(whole)
    term = (F.col("loop") + F.coalesce("inside", F.lit(0.0))) / F.lit(whole) - resolution * share * share
    return per.join(arcs.inside(state), "community", "left").agg(F.coalesce(F.sum(term), F.lit(0.0))).first()[0]


def _local_moves(arcs: DataFrame, labels: DataFrame, score: float, whole: float, resolution: float, tolerance: float) -> DataFrame | None:
    """The best partition (node, community) reached at one level, None if nothing improved. ``labels`` (name, node) name the nodes."""
    state = cut(alone(arcs))
    named = cut(labels.join(state.select("node"), "node", "left_semi"))
    # null nodes weigh in the degrees of the moves, but belong to no community
    loop = F.sum(F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(0.0))
    known = arcs.filter("src is not null and dst is not null").groupBy(F.col("src").alias("node"))
    degrees = cut(known.agg(F.sum("weight").alias("total"), loop.alias("loop")))
    within = degrees.agg(F.sum("total")).first()[0]
    between = _Arcs(arcs)
    try:
        kept, work = None, None
        for step in count():
            before = state
            state = _both_halves(between, state, named, whole, resolution, step, work)
            reached = _reached(between, degrees, state, within, resolution)
            gained = reached - score
            if gained > 0:
                kept, score = state, reached
            if gained < tolerance:
                break
            changed = state.join(before.select("node", F.col("community").alias("_old")), "node").filter("community <> _old").select("node")
            work = cut(between.beside(cut(changed)))
        return kept.select("node", "community") if kept is not None else None
    finally:
        between.free()


def move_pass(arcs: DataFrame, state: DataFrame, whole: float, resolution: float, step: int, work: DataFrame | None = None) -> DataFrame:
    """One half of the nodes moves, then the other; of ``work`` (node) only, if given."""
    between = _Arcs(arcs)
    try:
        return _both_halves(between, state, state.select("node", F.col("node").alias("name")), whole, resolution, step, work)
    finally:
        between.free()


def _both_halves(arcs: _Arcs, state: DataFrame, labels: DataFrame, whole: float, resolution: float, step: int, work: DataFrame | None) -> DataFrame:
    for half in (0, 1):
        draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(step), "name")), 1, 8), 16, 10).cast("bigint")
        drawn = labels.filter(draw % 2 == half).select("node")
        if work is not None:
            drawn = drawn.join(work, "node", "left_semi")
        movers = cut(state.join(drawn, "node", "left_semi").select("node", "k", F.col("community").alias("own")))
        state = cut(_round(arcs, state, movers, whole, resolution))
    return state


def _round(arcs: _Arcs, state: DataFrame, movers: DataFrame, whole: float, resolution: float) -> DataFrame:
    # written, so that the options of a community that holds much of the graph can be split
    totals = cut(state.groupBy("community").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("members")))
    options = arcs.links(movers, state).join(totals, "community")
    home = F.col("community") == F.col("own")

    def gain(w: Column, total: Column) -> Column:
        return F.round(w - resolution * F.col("k") * total / whole, 9)

    there = gain(F.col("w"), F.col("total"))
    # two nodes that are both alone would swap places for ever: of such a pair only the one with the larger name moves
    no_swap = (F.col("members") > 1) | (F.col("community") < F.col("own"))
    choice, rank = F.struct("community", there.alias("gain")), F.struct(-there, F.col("community"))
    chosen = options.groupBy("node").agg(
        F.min_by(choice, F.when(~home, rank)).alias("_any"),
        F.min_by(choice, F.when(~home & no_swap, rank)).alias("_safe"),
        F.max(F.when(home, F.col("w"))).alias("_w"),
    )
    mine = movers.join(totals.withColumnRenamed("community", "own"), "own")
    best = F.when(F.col("members") > 1, F.col("_any")).otherwise(F.col("_safe"))
    stay = gain(F.coalesce("_w", F.lit(0.0)), F.col("total") - F.col("k"))
    leaving = chosen.join(mine, "node").withColumn("_best", best).filter(F.col("_best.gain") > stay)
    moved = leaving.select("node", F.col("_best.community").alias("_to"))
    return state.join(moved, "node", "left").select("node", "k", F.coalesce("_to", "community").alias("community"))


def community_sizes(members: DataFrame, at_least: int = 3) -> DataFrame:
    """Sizes of the communities with enough members."""
    return members.groupBy("community").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") >= at_least)
