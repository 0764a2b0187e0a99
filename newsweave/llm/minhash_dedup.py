"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set of word shingles is sketched to ``BANDS * ROWS`` coordinates: in each round every element is hashed
to a coordinate and a value, the round number added, and a coordinate keeps its least value. Rounds end as soon as
every coordinate is filled; should chance leave gaps after as many rounds as coordinates, a further round for each
coordinate offers it all elements, so none stays empty. Equal coordinates of two sketches estimate the Jaccard
similarity with the concentration of independent samples. Sets that share a band of ``ROWS`` coordinates are
candidates: at a similarity of 0.8 a pair without a common band has a chance of 3e-6, at 0.85 of 7e-9.

Documents with equal sets are one node from the start (128 bits of the set's hashes). Candidates of a band are not
paired with each other: all meet the band's least and greatest node, and only what is then still in different
components meets in blocks of bounded size, inside a task that returns a row per node and not its pairs. Candidates of
the first kind whose sketches make the wanted similarity all but impossible (``SLACK`` standard deviations) end there; all
others are verified on the full sets with whole numbers.

Edge cases: null texts and texts without words have the empty set and are linked with nothing; fewer words than a
shingle make one shingle of the whole sequence; rows with a null doc_id link like others but name no component: a group
without any doc_id has component null and keeps all its rows. Rows that repeat a doc_id are judged by their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.llm.components import connected
from newsweave.llm.texts import NOT_SPACE, Words, mix, ngram_hashes, plain, slabs, small_batches
from newsweave.session import cut

ROWS, BANDS = 5, 32
SLACK = 5.0
BLOCK = 1000  # nodes of one side of a block of candidates
_SEEDS = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_SKETCH = "n_shingles bigint, node bigint, check bigint, sketch binary"


def shingle_sets(raw: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi in slabs(raw):
        words = Words(raw[lo:hi], NOT_SPACE)
        runs = ngram_hashes(words.hashes, width)
        for i in range(hi - lo):
            begin, end = words.first[i], words.first[i + 1]
            if end - begin >= width:
                yield np.unique(runs[begin : end - width + 1])
            else:
                yield ngram_hashes(words.hashes[begin:end], end - begin) if end > begin else np.zeros(0, np.uint64)


def fast_sketch(elements: np.ndarray, size: int = ROWS * BANDS) -> np.ndarray:
    """Least (round, value) of every coordinate; all are filled if there is any element."""
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    if not len(elements):
        return least
    for step in range(size):
        hashed = mix(elements ^ _SEEDS[step])
        value = np.uint64(step) << np.uint64(32) | hashed & np.uint64(0xFFFFFFFF)
        np.minimum.at(least, ((hashed >> np.uint64(32)) % np.uint64(size)).astype(np.int64), value)
        if least.max() >> np.uint64(32) <= size:
            return least
    for step in range(size):
        value = mix(elements ^ _SEEDS[size + step]) & np.uint64(0xFFFFFFFF) | np.uint64(size + step) << np.uint64(32)
        least[step] = min(least[step], value.min())
    return least


def sketches(text: Column, width: int) -> Column:
    """Struct of the set's size, two independent 64-bit fingerprints and two bytes of each sketch coordinate."""

    @F.pandas_udf(_SKETCH)
    def sketch(texts: pd.Series) -> pd.DataFrame:
        out = []
        for found in shingle_sets(plain(texts), width):
            short = (mix(fast_sketch(found)) >> np.uint64(48)).astype("<u2").tobytes() if len(found) else None
            prints = [int(mix(found ^ np.uint64(s)).sum(dtype=np.uint64).astype(np.int64)) for s in (0x1234567, 0x89ABCDEF01)]
            out.append((len(found), *prints, short))
        return pd.DataFrame(out, columns=["n_shingles", "node", "check", "sketch"])

    return sketch(text)


def _estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    left, right = (np.frombuffer(b"".join(x), "<u2").reshape(len(a), -1) for x in (a, b))
    return pd.Series((left == right).mean(1))


def _alike(percent: int, size: Column, other: Column, estimate: Column) -> Column:
    """Could the pair reach the similarity, by the sizes (exactly) and by the sketches?"""
    least = percent / 100 - SLACK * (percent / 100 * (1 - percent / 100) / (ROWS * BANDS)) ** 0.5
    return (F.least(size, other) * 100 >= F.greatest(size, other) * percent) & (estimate >= least)


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, members): the full set of each node, made again from the text of its first document."""

    @F.pandas_udf("binary")
    def full(texts: pd.Series) -> pd.Series:
        return pd.Series([s.tobytes() for s in shingle_sets(plain(texts), width)], dtype=object)

    texts = docs.select(F.col("row_key"), "text").join(nodes, "row_key")
    return texts.select("node", full("text").alias("members"))


def _verified(a: pd.Series, b: pd.Series, percent: pd.Series) -> pd.Series:
    out = []
    for x, y, p in zip(a, b, percent, strict=True):
        left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(left, right, assume_unique=True))
        out.append(100 * both >= int(p) * (len(left) + len(right) - both))
    return pd.Series(out, dtype=bool)


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow the similarity."""
    a = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("a_size"), F.col("sketch").alias("a_sketch"))
    b = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("b_size"), F.col("sketch").alias("b_sketch"))
    both = pairs.join(a, "a").join(b, "b")
    return both.where(_alike(percent, F.col("a_size"), F.col("b_size"), F.pandas_udf(_estimate, "double")("a_sketch", "b_sketch"))).select("a", "b")


def _verify(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidates that are similar by their full sets."""
    both = candidates.join(sets.select(F.col("node").alias("a"), F.col("members").alias("left")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("members").alias("right")), "b")
    return cut(both.where(F.pandas_udf(_verified, "boolean")("left", "right", F.lit(percent))).select("a", "b"))


def similar_roots(first: list[np.ndarray], second: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Least number joined with each set by similar pairs, numbers running through ``first`` and then ``second``.

    Pairs are those between the two lists, or all within ``first`` if there is no second. A set is marked once in an
    array over the block's shingles, and its intersections with all others are sums over that array.
    """
    sets = [*first, *(second or ())]
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    others = slice(len(first), None) if second is not None else slice(0, None)
    marks = np.zeros(int(flat.max()) + 1, np.int32)
    root = np.arange(len(sets))
    base = starts[others][0]
    for i in range(len(first)):
        own = flat[starts[i] : starts[i] + sizes[i]]
        marks[own] = 1
        both = np.add.reduceat(marks[flat[base:]], starts[others] - base)
        marks[own] = 0
        alike = np.flatnonzero(100 * both >= percent * (sizes[i] + sizes[others] - both)) + (len(first) if second is not None else 0)
        joined = np.unique(root[np.append(alike, i)])
        if len(joined) > 1:
            root[np.isin(root, joined)] = joined[0]
    return root


def _blocks(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of a band that are still in different components, block against block.

    All pairs of two blocks are compared exactly inside a task; what comes out is a row per node at most, joining it to
    the least node it belongs with there.
    """
    open_ = members.where("size > 3").select("bucket", "node", "size").join(roots, "node", "left")
    open_ = cut(open_.withColumn("root", F.coalesce("root", "node")))
    mixed = open_.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
    rows = open_.join(mixed, "bucket").join(sets, "node")
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "members")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["own", "node"])
        own, nodes = rows["own"].to_numpy(), rows["node"].to_numpy()
        found = [np.frombuffer(m, np.uint64) for m in rows["members"]]
        split = int((own == key[1]).sum())
        if not split or (key[1] != key[2] and split == len(rows)):
            return pd.DataFrame(np.zeros((0, 2), np.int64), columns=["a", "b"])
        root = similar_roots(found[:split], found[split:] if key[1] != key[2] else None, percent)
        joined = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": nodes[root[joined]], "b": nodes[joined]})

    return rows.groupBy("bucket", "lo", "hi").applyInPandas(compare, "a bigint, b bigint").distinct()


def _ordered(members: DataFrame, leader: str) -> DataFrame:
    pairs = members.where(F.col("node") != F.col(leader))
    return pairs.select(F.least("node", leader).alias("a"), F.greatest("node", leader).alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """row_key (hash of doc_id and text), doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Linked are documents whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` hundredths or
    more; a component takes the smallest doc_id reachable, and the document of that id is kept.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    marks = cut(docs.select("doc_id", "row_key", sketches(F.col("text"), width).alias("s")).select("doc_id", "row_key", "s.*"))
    classes = marks.where("n_shingles > 0").groupBy("node", "check")
    classes = cut(classes.agg(F.min("doc_id").alias("doc"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")))
    bands = classes.select("node", "sketch", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    bands = bands.select("node", F.xxhash64("band", F.substring("sketch", F.col("band") * (2 * ROWS) + 1, F.lit(2 * ROWS))).alias("bucket"))
    buckets = bands.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high")
    members = cut(bands.join(buckets, "bucket"))
    stars = _ordered(members, "low").unionByName(_ordered(members, "high")).distinct()
    candidates = cut(_candidates(stars, classes, percent))
    wanted = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node")))
    wanted = wanted.unionByName(members.where("size > 3").select("node")).distinct()
    sets = cut(_sets(docs, classes.join(wanted, "node").select("row_key", "node"), width))
    links = _verify(candidates, sets, percent)
    rest = cut(_blocks(members, connected(links), sets, percent))
    roots = connected(links.unionByName(rest))
    named = cut(classes.join(roots, "node", "left").select("node", "doc", F.coalesce("root", "node").alias("root")))
    least = named.groupBy("root").agg(F.min("doc").alias("least"))
    named = cut(named.join(least, "root").select("node", "least"))
    found = marks.join(named, "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return found.select("row_key", "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id, columns as they came."""
    key = "_".join(["row", *docs.columns])  # a name no column has
    gone = near_duplicates(docs, width, percent).where(~F.col("kept")).select(F.col("row_key").alias(key)).distinct()
    return docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == gone[key], "left_anti")
