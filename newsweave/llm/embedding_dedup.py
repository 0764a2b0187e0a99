"""Near-duplicate embeddings by a flat, robustly pruned neighbour graph.

Equal vectors are one node. Nodes go to shards around centroids (spherical k-means on a bounded sample); a node belongs
to its ``overlap`` nearest shards, so that neighbouring shards share their border. In each shard every node gets a robustly
pruned list of neighbours: a candidate is left out if a neighbour taken before is much nearer to it than the node
is, which keeps some long edges beside the short ones. The lists a node has in several shards are united. The search
for a node's links starts at the shard's medoid, walks greedily with a beam, and from the first nodes within range expands
everything in range until nothing new is. Links are the visited nodes whose cosine in double precision reaches the bound.

Links are counted and joined to components inside the tasks: a shard gives one count and one root per node, so a
group of alike vectors gives as many rows as it has members. A pair in several shards counts in the first one they share.
Shards of more than ``BLOCK`` nodes are divided; each part has a graph, which is searched by the nodes of every part.

After every search a sample of at most ``AUDIT`` nodes is compared with all nodes. The recall is the least of three: the
share of all links, the mean of the nodes' shares, and that mean over nodes of at most ``SPARSE`` links, which hot
groups cannot hide. Below ``RECALL`` overlap, beam and degree are doubled and the search is repeated; should it fall
short with every node in every shard, blocks are compared exactly.

Edge cases: vectors that are null, zero, or hold nulls, NaN or infinities link with nothing; so do rows without a vec_id;
vectors of different length are never compared. Rows that repeat a vec_id are judged by their vectors.
"""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.components import connected
from newsweave.llm.texts import small_batches
from newsweave.session import cut

_log = logging.getLogger(__name__)

COSINE = 0.9
SHARD, BLOCK = 1500, 4000
MOST_SHARDS, SAMPLE = 1024, 20_000
OVERLAP = 3
NEAREST, FAR, DEGREE, ALPHA, BEAM = 48, 16, 24, 1.2, 24
AUDIT, RECALL, SPARSE = 1000, 0.97, 20


def usable(vector: Column) -> Column:
    """Not null, no null, NaN or infinite component, not all zero."""
    fine = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors) -> np.ndarray:
    """Rows of length one in double precision."""
    found = np.stack([np.asarray(v, np.float64) for v in vectors])
    found /= np.abs(found).max(1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def centroids(nodes: DataFrame, count: int, sample: int = SAMPLE) -> np.ndarray:
    """Spherical k-means on at most ``sample`` nodes of least hash."""
    rows = nodes.select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(sample).toPandas()
    points = unit(rows["vector"])
    rng = np.random.default_rng(7)
    middle = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(8):
        near = np.concatenate([(points[lo : lo + 4096] @ middle.T).argmax(1) for lo in range(0, len(points), 4096)])
        total = np.zeros_like(middle)
        np.add.at(total, near, points)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        middle = np.where(norm > 0, total / np.where(norm > 0, norm, 1), middle)
    return middle


def place(nodes: DataFrame, middle: np.ndarray, overlap: int) -> DataFrame:
    """(node, vector, copies, shards): the nearest shards of every node, in ascending order."""
    sent = nodes.sparkSession.sparkContext.broadcast(middle)
    take = min(overlap, len(middle))

    @F.pandas_udf("array<int>")
    def shards(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        near = np.argpartition(-(unit(vectors) @ sent.value.T), take - 1, axis=1)[:, :take]
        return pd.Series(list(np.sort(near, 1).astype(np.int32)))

    return nodes.withColumn("shards", shards("vector"))


def prune(alike: np.ndarray, own: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[int]:
    """Places of the candidates kept. alike: cosines among the candidates, own: with the node, falling."""
    far, own_far = np.sqrt(np.maximum(0, 2 - 2 * alike)), np.sqrt(np.maximum(0, 2 - 2 * own))
    open_, kept = np.ones(len(own), bool), []
    for i in range(len(own)):
        if open_[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            open_ &= ~(alpha * far[i] <= own_far)
            open_[i] = False
    return kept


def neighbours(vectors: np.ndarray, seed: int, degree: int = DEGREE) -> list[np.ndarray]:
    """Pruned list of each row among the rows: near candidates and some anywhere."""
    count = len(vectors)
    rng = np.random.default_rng(seed)
    out = []
    for lo in range(0, count, 1024):
        alike = vectors[lo : lo + 1024] @ vectors.T
        alike[np.arange(len(alike)), np.arange(lo, lo + len(alike))] = -2
        take = min(max(NEAREST, 2 * degree), count - 1)
        near = np.argpartition(-alike, take - 1, axis=1)[:, :take] if take else np.zeros((len(alike), 0), np.int64)
        for i, row in enumerate(near):
            other = rng.integers(0, count, FAR)
            these = np.unique(np.concatenate([row, other[other != lo + i]]))
            these = these[np.argsort(-alike[i, these], kind="stable")]
            kept = prune(vectors[these] @ vectors[these].T, alike[i, these], degree)
            # chains into a pruned list always include the nearest long edges, so that groups stay reachable
            far = these[-2:] if len(these) > 2 else these[:0]
            out.append(np.unique(np.concatenate([these[kept], far])))
    return out


def range_search(vectors: np.ndarray, lists: list[np.ndarray], start: int, query: np.ndarray, least: float, beam: int = BEAM) -> np.ndarray:
    """Rows with a cosine of at least ``least``: beam walk from ``start``, then everything in range expanded together."""
    seen = np.zeros(len(vectors), bool)
    seen[start] = True
    first = float(vectors[start] @ query)
    waiting, best = [(-first, start)], [first]
    inside = [start] if first >= least else []
    while waiting:
        alike, node = heapq.heappop(waiting)
        if -alike >= least:  # in range: expanded below together with the others
            break
        if len(best) == beam and -alike < best[0]:
            break
        new = lists[node][~seen[lists[node]]]
        seen[new] = True
        for value, other in zip((vectors[new] @ query).tolist(), new.tolist(), strict=True):
            if value >= least:
                inside.append(other)
            if len(best) < beam:
                heapq.heappush(best, value)
            elif value > best[0]:
                heapq.heapreplace(best, value)
            else:
                continue
            heapq.heappush(waiting, (-value, other))
    edge = np.array(sorted(set(inside)), np.int64)
    found = [edge]
    while len(edge):
        new = np.unique(np.concatenate([lists[i] for i in edge]))
        new = new[~seen[new]]
        seen[new] = True
        edge = new[vectors[new] @ query >= least]
        found.append(edge)
    return np.concatenate(found)


def roots_of(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row reachable over the links a-b."""
    root = np.arange(count)
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        root = root[root]
        if (root == before).all():
            return root


def _graphs(placed: DataFrame, degree: int = DEGREE) -> DataFrame:
    """(node, lists): the united neighbour lists of every node, as node keys."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        keys = rows["node"].to_numpy()
        lists = neighbours(unit(rows["vector"]), int(key[0]), degree)
        return pd.DataFrame({"node": keys, "near": [keys[own] for own in lists]})

    found = placed.groupBy("shard", "block").applyInPandas(build, "node bigint, near array<bigint>")
    return found.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("lists"))


def _search(placed: DataFrame, least: float, beam: int | None = BEAM) -> DataFrame:
    """(node, root, links): per task and node, the copies of its linked nodes and the least node joined with it there.

    Without a beam all vectors are compared.
    """

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, lo, hi = key
        rows = rows.sort_values("node").reset_index(drop=True)
        nodes, copies, block = rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        vectors, shards = unit(rows["vector"]), np.stack(list(rows["shards"]))
        graph = np.flatnonzero(block == hi)
        spot = {int(nodes[i]): j for j, i in enumerate(graph)}
        lists = [np.array([spot[n] for n in rows["lists"].iloc[i] if n in spot], np.int64) for i in graph]
        inner = vectors[graph]
        pairs = []
        if len(graph):
            start = int((inner @ inner.mean(0)).argmax())
            for i in np.flatnonzero(block == lo):
                found = graph[inner @ vectors[i] >= least if beam is None else range_search(inner, lists, start, vectors[i], least, beam)]
                found = found[found != i]
                pairs.append(np.stack([np.minimum(found, i), np.maximum(found, i)], 1))
        links = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        # the first shard both are in counts the pair
        common = np.full(len(links), np.iinfo(np.int32).max)
        for c in range(shards.shape[1]):
            value = shards[links[:, 0], c]
            shared = (shards[links[:, 1]] == value[:, None]).any(1)
            common = np.where(shared, np.minimum(common, value), common)
        links = links[common == shard]
        root = roots_of(len(nodes), links[:, 0], links[:, 1])
        total = np.bincount(links[:, 0], copies[links[:, 1]], len(nodes)) + np.bincount(links[:, 1], copies[links[:, 0]], len(nodes))
        some = np.flatnonzero(total)
        return pd.DataFrame({"node": nodes[some], "root": nodes[root[some]], "links": total[some].astype(np.int64)})

    blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    both = placed.withColumn("other", F.explode(blocks)).select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    return both.groupBy("shard", "lo", "hi").applyInPandas(search, "node bigint, root bigint, links bigint")


def audit_recall(nodes: DataFrame, found: DataFrame, least: float, sample: int = AUDIT) -> float:
    """Recall of the links of at most ``sample`` nodes (of least hash): of all links, per node, or per sparse node, the least."""
    spark = nodes.sparkSession
    asked = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(sample).select("node", "vector").toPandas()
    if not len(asked):
        return 1.0
    sent = spark.sparkContext.broadcast((asked["node"].to_numpy(), unit(asked["vector"])))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, queries = sent.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            alike = (unit(batch["vector"]) @ queries.T >= least) & (batch["node"].to_numpy()[:, None] != keys)
            total += batch["copies"].to_numpy(np.int64) @ alike
        yield pd.DataFrame({"node": keys, "n": total})

    true = nodes.mapInPandas(compare, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
    both = true.where("n > 0").join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    both = both.select("n", F.coalesce("links", F.lit(0)).alias("links")).toPandas()  # at most ``sample`` rows
    if not len(both):
        return 1.0
    total, own = both["links"].sum() / both["n"].sum(), both["links"] / both["n"]
    sparse = own[both["n"] <= SPARSE]
    return float(min([total, own.mean(), *([sparse.mean()] if len(sparse) else [])]))


def _links(nodes: DataFrame, least: float, overlap: int) -> DataFrame:
    """(node, root, links) of all nodes with links, from the graph search; repeated with more effort where the audit asks for it."""
    count = nodes.count()
    shards = max(1, min(MOST_SHARDS, -(-count // SHARD)))
    middle = centroids(nodes, shards)
    beam, degree = BEAM, DEGREE
    while True:
        placed = place(nodes, middle, overlap)
        placed = cut(placed.withColumn("shard", F.explode("shards")))
        sizes = placed.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        placed = placed.join(F.broadcast(sizes), "shard")  # at most MOST_SHARDS rows
        placed = cut(placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
        lists = cut(_graphs(placed, degree))
        found = cut(_search(placed.join(lists, "node"), least, beam))
        recall = audit_recall(nodes, found, least)
        _log.info("recall %.4f of %d nodes, overlap %d of %d shards, beam %s", recall, count, overlap, len(middle), beam)
        if beam is None or recall >= RECALL:
            return found
        if overlap >= len(middle):
            middle, beam, degree = middle[:1], None, DEGREE
        else:
            overlap, beam, degree = min(len(middle), 2 * overlap), 2 * beam, 2 * degree


def near_vectors(vectors: DataFrame, least: float = COSINE, overlap: int = OVERLAP) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    small_batches(spark, 2000)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    fine = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    rows = cut(rows.select("vec_id", F.when(fine, F.xxhash64("vector")).alias("node"), F.when(fine, F.col("vector")).alias("vector")))
    nodes = rows.where("node IS NOT NULL").groupBy("node", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    nodes = cut(nodes)
    sizes = [r[0] for r in nodes.select(F.size("vector")).distinct().collect()]
    found = [_links(nodes.where(F.size("vector") == size), least, overlap) for size in sorted(sizes)]
    links = spark.createDataFrame([], "node bigint, root bigint, links bigint")
    for more in found:
        links = links.unionByName(more)
    roots = connected(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "copies", "least").join(roots, "node", "left").join(totals, "node", "left")
    named = cut(named.withColumn("root", F.coalesce("root", "node")))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component")), "root")
    out = rows.select("vec_id", "node").join(named.select("node", "copies", "links", "component"), "node", "left")
    component = F.coalesce("component", "vec_id")
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return out.select("vec_id", n_links.cast("bigint").alias("n_links"), component.cast("bigint").alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
