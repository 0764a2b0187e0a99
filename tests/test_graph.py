import itertools
import random
from collections import deque

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweave import session
from newsweave.operators import centrality as ce
from newsweave.operators import communities as co
from newsweave.operators import graph as gr
from newsweave.operators import paths


def graph_of(spark, edges):
    return spark.createDataFrame([(min(e[:2]), max(e[:2]), e[2] if len(e) > 2 else 1) for e in edges], "src string, dst string, weight long")


def random_edges(seed, nodes, count):
    generator = random.Random(seed)
    names = [f"n{i}" for i in range(nodes)]
    pairs = {tuple(sorted(generator.sample(names, 2))) for _ in range(count)}
    # a hub touching most nodes, and a self loop
    pairs |= {tuple(sorted(("hub", n))) for n in names[: nodes * 2 // 3]}
    return sorted((a, b, generator.randint(1, 5)) for a, b in pairs) + [("n0", "n0", 2)]


def power_iteration(edges, alpha=0.85, rounds=200):
    weights = {}
    for a, b, w in edges:
        weights.setdefault(a, {})[b] = w
        weights.setdefault(b, {})[a] = w
    n = len(weights)
    rank = dict.fromkeys(weights, 1 / n)
    for _ in range(rounds):
        fresh = dict.fromkeys(weights, (1 - alpha) / n)
        for a, out in weights.items():
            total = sum(out.values())
            for b, w in out.items():
                fresh[b] += alpha * rank[a] * w / total
        rank = fresh
    return rank


def brute_betweenness(edges):
    around = {}
    for a, b, *_ in edges:
        around.setdefault(a, set())
        around.setdefault(b, set())
        if a != b:
            around[a].add(b)
            around[b].add(a)

    def search(root):
        dist, paths, queue = {root: 0}, {root: 1}, deque([root])
        while queue:
            v = queue.popleft()
            for w in around[v]:
                if w not in dist:
                    dist[w], paths[w] = dist[v] + 1, 0
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    paths[w] += paths[v]
        return dist, paths

    found = {v: search(v) for v in around}
    n = len(around)
    result = dict.fromkeys(around, 0.0)
    for s, t in itertools.permutations(around, 2):
        dist, paths = found[s]
        if t not in dist:
            continue
        for v in around:
            if v not in (s, t) and v in dist and t in found[v][0] and dist[v] + found[v][0][t] == dist[t]:
                result[v] += paths[v] * found[v][1][t] / paths[t]
    return {v: total / ((n - 1) * (n - 2)) for v, total in result.items()}


def test_reverse_pair_overwrites_the_weight(spark):
    edges = spark.createDataFrame([("A", "B")] * 3 + [("B", "A")], "source string, target string")
    assert gr.undirected_weighted(edges).collect() == [("A", "B", 1)]
    assert gr.undirected_weighted(edges, weight="sum").collect() == [("A", "B", 4)]


def test_degrees_count_a_loop_twice(spark):
    found = {r["node"]: r for r in gr.degree_centrality(graph_of(spark, [("a", "a"), ("a", "b")])).collect()}
    assert found["a"]["degree"] == 3 and found["a"]["degree_centrality"] == 3.0
    single = gr.degree_centrality(graph_of(spark, [("a", "a")])).first()
    assert single["degree_centrality"] == 1.0


@pytest.mark.parametrize("edges_per_part", [100_000, 3])
def test_pagerank(spark, edges_per_part):
    edges = random_edges(1, 20, 30)
    expected = power_iteration(edges)
    found = {r[0]: r[1] for r in ce.pagerank(graph_of(spark, edges), tol=1e-9, edges_per_part=edges_per_part).collect()}
    assert found == pytest.approx(expected, abs=1e-7)
    assert sum(found.values()) == pytest.approx(1.0)


def test_pagerank_directed_with_dangling_nodes(spark):
    graph = spark.createDataFrame([("a", "b", 1), ("c", "b", 1)], "src string, dst string, weight long")
    found = {r[0]: r[1] for r in ce.pagerank(graph, directed=True).collect()}
    assert sum(found.values()) == pytest.approx(1.0)
    assert found["a"] == pytest.approx(found["c"]) and found["b"] > found["a"]


def test_pagerank_reports_missing_convergence(spark):
    with pytest.raises(RuntimeError):
        ce.pagerank(graph_of(spark, random_edges(2, 10, 10)), tol=1e-15, max_iter=2)


@pytest.mark.parametrize(("state_rows", "edges_per_part"), [(10**6, 100_000), (100, 4)])
def test_betweenness(spark, monkeypatch, state_rows, edges_per_part):
    edges = [*random_edges(3, 14, 12), ("x", "y"), ("y", "z"), ("z", "w")]
    states, written, original = [], [], ce._dependencies
    monkeypatch.setattr(ce, "_dependencies", lambda roots, *rest: states.append(roots.count()) or original(roots, *rest))
    monkeypatch.setattr(ce, "cut", lambda df: written.append(session.cut(df)) or written[-1])
    found = {r[0]: r[1] for r in ce.betweenness(graph_of(spark, edges), state_rows, edges_per_part).collect()}
    assert found == pytest.approx(brute_betweenness(edges))
    nodes = len({n for e in edges for n in e[:2]})
    assert sum(states) == nodes and len(states) == max(1, -(-nodes * nodes // state_rows))
    assert max(states) * nodes <= 2.5 * state_rows
    levels = [f for df in written for f in df.inputFiles() if "scope-" in f]
    assert levels and not any(os.path.exists(f.removeprefix("file://")) for f in levels)  # no batch leaves its levels


def test_levels_of_betweenness_are_tiles(spark, monkeypatch):
    """60 nodes in tiles of 16 nodes and 8 roots: a level has at most 4 x 8 rows, not one per root and node."""
    edges = random_edges(5, 60, 90)
    rows, inner, original = [], [], ce._dependencies
    monkeypatch.setattr(ce, "NODES_PER_TILE", 16, raising=False)
    monkeypatch.setattr(ce, "ROOTS_PER_TILE", 8, raising=False)
    monkeypatch.setattr(ce, "_dependencies", lambda *a: inner.append(True) or original(*a))

    def cut(df):
        found = session.cut(df)
        if inner and "root" in found.columns:
            rows.append(found.count())
        return found

    monkeypatch.setattr(ce, "cut", cut)
    found = {r[0]: r[1] for r in ce.betweenness(graph_of(spark, edges), edges_per_part=5).collect()}
    assert found == pytest.approx(brute_betweenness(edges))
    assert rows and max(rows) <= 32


def test_betweenness_of_tiny_graphs(spark):
    assert {r[1] for r in ce.betweenness(graph_of(spark, [("a", "b")])).collect()} == {0.0}
    assert {r[1] for r in ce.betweenness(graph_of(spark, [("a", "a")])).collect()} == {0.0}


@pytest.mark.parametrize(("entries", "arcs", "kept"), [(1 << 18, 1 << 17, 1 << 23), (1, 3, 0), (70, 5, 40)])
def test_dependencies_in_arrays(monkeypatch, entries, arcs, kept):
    """Levels found from either side, some roots at once, arcs in pieces: a hub, a path, nodes without arcs, two components."""
    monkeypatch.setattr(paths, "ENTRIES_AT_ONCE", entries)
    monkeypatch.setattr(paths, "ARCS_AT_ONCE", arcs)
    monkeypatch.setattr(paths, "ARCS_KEPT", kept)
    star, path = [(0, i) for i in range(1, 9)], [(i, i + 1) for i in range(8, 14)]
    for edges in (star + path + [(3, 5), (20, 21), (21, 22)], random_edges(7, 23, 40), [(i, j) for i in range(6) for j in range(i)]):
        pairs = [(str(a), str(b)) for a, b, *_ in edges if a != b]
        wanted = brute_betweenness(pairs)
        names = sorted(wanted) + ["without arcs"]
        both = sorted((names.index(a), names.index(b)) for pair in pairs for a, b in (pair, pair[::-1]))
        first = np.searchsorted([a for a, _ in both], np.arange(len(names) + 1))
        found = paths.dependencies(first, np.array([b for _, b in both], np.int32), np.arange(len(names)))
        scale = (len(wanted) - 1) * (len(wanted) - 2)
        assert dict(zip(names, found / scale)) == pytest.approx(wanted | {"without arcs": 0.0})


@pytest.mark.parametrize("held", [0, 10**8])
def test_neither_arcs_nor_state_of_betweenness_are_shuffled(spark, monkeypatch, held):
    """Arcs that workers can hold are sent once; only a larger graph goes by lists of arcs repeated per roots, with the same result."""
    edges, tiled, original = [*random_edges(5, 60, 90), ("x", "y"), ("q", "q")], [], ce._arc_lists
    monkeypatch.setattr(ce, "ARCS_HELD", held, raising=False)
    monkeypatch.setattr(ce, "NODES_PER_TILE", 16)
    monkeypatch.setattr(ce, "ROOTS_PER_TILE", 8)
    monkeypatch.setattr(ce, "_arc_lists", lambda *a: tiled.append(True) or original(*a))
    found = {r[0]: r[1] for r in ce.betweenness(graph_of(spark, edges), edges_per_part=5).collect()}
    assert found == pytest.approx(brute_betweenness(edges))
    assert bool(tiled) == (held == 0)


def test_top_brokers_come_without_lists_of_arcs(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("arcs are not to be repeated for the roots")

    monkeypatch.setattr(ce, "_arc_lists", refuse)
    edges = random_edges(6, 15, 20)
    found = ce.betweenness(graph_of(spark, edges)).select(F.col("node").alias("entity"), F.round("betweenness", 6).alias("betweenness"))
    wanted = sorted((-round(value, 6), node) for node, value in brute_betweenness(edges).items())[:5]
    assert [r["entity"] for r in ce.top_brokers(found).collect()] == [node for _, node in wanted]


def test_node_metrics_leave_one_table(spark, monkeypatch):
    """Rounds of PageRank and the tables of betweenness go before the result is returned."""
    written = []
    monkeypatch.setattr(ce, "cut", lambda df: written.append(session.cut(df)) or written[-1])
    edges = random_edges(4, 12, 20)
    found = {r["entity"]: r for r in ce.node_metrics(graph_of(spark, edges)).collect()}
    assert {k: r["betweenness"] for k, r in found.items()} == pytest.approx(brute_betweenness(edges))
    assert sum(r["pagerank"] for r in found.values()) == pytest.approx(1.0)
    files = [f for df in written for f in df.inputFiles()]
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_communities_of_two_cliques(spark):
    cliques = [(f"{c}{i}", f"{c}{j}") for c in "ab" for i in range(5) for j in range(i)]
    graph = graph_of(spark, [*cliques, ("a0", "b0")])
    found = co.communities(graph)
    groups = {}
    for r in found.collect():
        groups.setdefault(r["community"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [[f"a{i}" for i in range(5)], [f"b{i}" for i in range(5)]]
    alone = found.withColumn("community", F.col("node"))
    assert co.modularity(graph, found).first()[0] > co.modularity(graph, alone).first()[0]
    assert co.modularity(graph, found).first()[0] == pytest.approx(20 / 21 - 0.5)
    assert sorted(r["members"] for r in co.community_sizes(found).collect()) == [5, 5]


def test_communities_are_connected_pieces(spark):
    graph = graph_of(spark, [("a", "b"), ("b", "c"), ("x", "y"), ("c", "x"), ("p", "q")])
    torn = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("x", "1"), ("y", "1"), ("p", "3"), ("q", "3")], "node string, community string")
    found = {r["node"]: r["community"] for r in co.connected_pieces(co.symmetric(graph), torn).collect()}
    assert found == {"a": "a", "b": "a", "c": "c", "x": "x", "y": "x", "p": "p", "q": "p"}


def test_communities_cover_every_node_once(spark):
    graph = graph_of(spark, [*random_edges(5, 20, 25), ("p", "q")])
    found = co.communities(graph).collect()
    nodes = {r["node"] for r in gr.graph_nodes(graph, "src", "dst").collect()}
    assert len(found) == len(nodes) and {r["node"] for r in found} == nodes


def test_rounds_of_communities_leave_the_arcs_where_they_are(spark):
    arcs = session.cut(co.symmetric(graph_of(spark, random_edges(5, 20, 60))))
    state = session.cut(co.alone(arcs))
    between = co._Arcs(arcs)
    try:
        links = between.links(session.cut(state.select("node", "k", F.col("community").alias("own"))), state)
        links.collect()
        assert "hashpartitioning" not in links._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    finally:
        between.free()


def test_hubs_of_communities_are_added_up_by_all_tasks(spark, monkeypatch):
    arcs = session.cut(co.symmetric(graph_of(spark, random_edges(5, 20, 40))))
    state, between = session.cut(co.alone(arcs)), arcs.filter("src <> dst")
    whole = sorted(map(tuple, co.move_pass(between, state, 200.0, 1.0, 0).collect()))
    monkeypatch.setattr(co, "HUB_ARCS", 10)
    divided = co._Arcs(arcs)
    divided.free()
    assert divided.hubs.filter("src = 'hub'").count() == 13 and divided.plain.filter("src = 'hub'").isEmpty()
    assert sorted(map(tuple, co.move_pass(between, state, 200.0, 1.0, 0).collect())) == whole


def test_neighbourhoods(spark):
    graph = graph_of(spark, [("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("d", "e")])
    rings = {r["node"]: r["hop"] for r in gr.khop(graph, spark.createDataFrame([("a",)], "n string"), 2).collect()}
    assert rings == {"a": 0, "b": 1, "c": 1, "d": 2}
    # the edge b-c between two neighbours stays
    assert {(r["src"], r["dst"]) for r in gr.ego_search(graph, "A").collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    # one pass only: d keeps its place although its degree falls
    star = graph_of(spark, [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d")])
    assert {(r["src"], r["dst"]) for r in gr.min_degree_subgraph(star).collect()} == {("a", "b")}


def test_empty_combinations_are_kept(spark):
    edges = spark.createDataFrame([("a", "b", "F", "leads"), ("a", "c", "H", "accuses")], "source string, target string, sentiment string, relationship string")
    assert sorted(map(tuple, gr.by_sentiment_and_relationship(edges).collect())) == [
        ("F", "accuses", 0), ("F", "leads", 1), ("H", "accuses", 1), ("H", "leads", 0),
    ]


def test_arcs_of_a_hub_are_divided(spark):
    edges = [("hub", f"n{i:03d}") for i in range(200)]
    placed, _ = ce.spread_arcs(ce.both_ways(graph_of(spark, edges)), edges_per_part=20)
    sizes = [r["count"] for r in placed.filter("src = 'hub'").groupBy("part").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 200 and max(sizes) < 60
