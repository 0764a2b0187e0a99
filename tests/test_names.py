import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsweave.operators import cells, similarity
from newsweave.operators import resolution as rs
from newsweave.operators.similarity import nearest, similar_pairs


def vectors_of(spark, matrix):
    rows = [(f"v{i}", i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "name string, seq bigint, embedding array<float>")


def cosines(matrix):
    matrix = np.asarray(matrix, dtype=np.float32).astype(float)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
    return unit @ unit.T


def sample(seed, n=120, dims=4):
    generator = np.random.default_rng(seed)
    matrix = generator.normal(size=(n, dims))
    matrix[40:80] = matrix[3]  # a third are copies of one vector
    matrix[90] = 0
    matrix[91] = 0
    return matrix


def sequential_clusters(matrix, threshold):
    near, canonical, visited = cosines(matrix) > threshold, {}, set()
    for i in range(len(matrix)):
        if i in visited:
            continue
        members = [i] + [j for j in range(i + 1, len(matrix)) if near[i, j]]
        visited.update(members)
        canonical.update(dict.fromkeys(members, i))
    return {f"v{i}": f"v{c}" for i, c in canonical.items()}


@pytest.mark.parametrize("rows_per_block", [2048, 10])
@pytest.mark.parametrize("threshold", [0.9, 0.2])
def test_all_pairs_are_found(spark, threshold, rows_per_block):
    matrix = sample(1)
    near = cosines(matrix)
    expected = {(i, j) for i in range(len(matrix)) for j in range(i + 1, len(matrix)) if near[i, j] > threshold}
    rows = similar_pairs(vectors_of(spark, matrix), threshold, rows_per_block).collect()
    assert len(rows) == len(expected)
    assert {(r["left_seq"], r["right_seq"]) for r in rows} == expected
    assert all(r["left"] == f"v{r['left_seq']}" and abs(r["cosine"] - near[r["left_seq"], r["right_seq"]]) < 1e-6 for r in rows)


@pytest.mark.parametrize("threshold", [0.97, 0.8, 0.3])
@pytest.mark.parametrize("seed", [2, 3])
def test_clusters_equal_the_sequential_scan(spark, seed, threshold):
    matrix = sample(seed)
    found = rs.cluster_names(vectors_of(spark, matrix), threshold, rows_per_block=25).collect()
    assert {r["alias"]: r["canonical"] for r in found} == sequential_clusters(matrix, threshold)
    assert all(r["is_leader"] == (r["alias"] == r["canonical"]) for r in found) and len(found) == len(matrix)


def test_clusters_in_batches_equal_the_sequential_scan(spark):
    matrix = sample(5, 200)
    found = rs.cluster_names(vectors_of(spark, matrix), 0.8, rows_per_block=25, first_batch=20).collect()
    assert {r["alias"]: r["canonical"] for r in found} == sequential_clusters(matrix, 0.8)


def test_a_large_cluster_makes_pairs_in_its_first_batch_only(spark, monkeypatch):
    """640 near copies: the first batch of 20 pairs them, later ones meet the one leader."""
    generator = np.random.default_rng(3)
    matrix = np.abs(generator.normal(size=8)) + generator.normal(scale=0.01, size=(640, 8))
    paired = []
    original = rs.pairs_above
    monkeypatch.setattr(rs, "pairs_above", lambda v, *a: paired.append(v.count()) or original(v, *a))
    found = rs.cluster_names(vectors_of(spark, matrix), 0.9, first_batch=20).collect()
    assert {r["canonical"] for r in found} == {"v0"} and len(found) == 640
    assert paired[0] == 20 and sum(paired[1:]) == 0 and len(paired) == 6


def near_copies(groups, each, dims=24, seed=7):
    """Groups of near copies around random centres, the number of groups growing with the rows."""
    generator = np.random.default_rng(seed)
    centres = generator.normal(size=(groups, dims))
    return np.repeat(centres, each, axis=0) + generator.normal(scale=0.05, size=(groups * each, dims))


def test_pairs_compared_per_vector_stay_flat(spark):
    per = []
    for groups in (50, 400):
        vectors = vectors_of(spark, near_copies(groups, 10)).select(F.col("seq").alias("id"), "embedding")
        pool, guests = cells.cells(vectors, cells.constant_limit(vectors, similarity.reach(0.88)), cells.angles, 64, rows_per_cell=4)
        per.append(cells.compared(pool, guests) / (groups * 10))
        assert pool.count() == groups * 10 and pool.groupBy("block").count().agg(F.max("count")).first()[0] <= 128
    assert per[1] <= 1.5 * per[0] and per[1] < 100


def test_rows_that_division_cannot_part(spark):
    """A thousand equal vectors and some others, in blocks of ten."""
    matrix = np.vstack([np.ones((1000, 3)), np.eye(3)])
    rows = vectors_of(spark, matrix).select(F.col("seq").alias("id"), "embedding")
    pool, _ = cells.cells(rows, cells.constant_limit(rows, 0.1), cells.angles, 10)
    assert pool.count() == 1003 and pool.groupBy("block").count().agg(F.max("count")).first()[0] <= 40


def test_guests_are_not_copied_into_cells_that_cannot_be_pruned(spark, monkeypatch):
    """Random directions and a wide angle: every vector may lie near any cell, so the division is given up before copies are made."""
    rows = vectors_of(spark, np.random.default_rng(9).normal(size=(300, 48))).select(F.col("seq").alias("id"), "embedding")
    made, original = [], cells.together
    monkeypatch.setattr(cells, "together", lambda *a: made.append(a[-1]) or original(*a))
    written, cut = [], cells.cut
    monkeypatch.setattr(cells, "cut", lambda df: written.append(cut(df)) or written[-1])
    pool, guests = cells.cells(rows, cells.constant_limit(rows, similarity.reach(0.35)), cells.angles, 64, rows_per_cell=4)
    assert pool.count() == 300 and guests.count() == 300 * 5
    assert made and max(df.count() for df in written) == 300


@pytest.mark.parametrize(("widest", "blocks"), [(1 << 15, 8), (20, 15)])
def test_large_cells_that_cannot_be_pruned_make_few_blocks(spark, monkeypatch, widest, blocks):
    """Every vector is copied into every block, so blocks of ten would make thirty copies of each."""
    monkeypatch.setattr(cells, "ROWS_PER_BLOCK", 10)
    monkeypatch.setattr(cells, "ROWS_PER_WIDE_BLOCK", widest, raising=False)
    matrix = np.random.default_rng(9).normal(size=(300, 48))
    rows = vectors_of(spark, matrix)
    vectors = rows.select(F.col("seq").alias("id"), "embedding")
    pool, guests = cells.cells(vectors, cells.constant_limit(vectors, similarity.reach(0.35)), cells.angles, 10, rows_per_cell=4)
    assert pool.count() == 300 and guests.count() == 300 * blocks
    near = np.triu(cosines(matrix), 1) > 0.35
    found = similar_pairs(rows, 0.35, 10).collect()
    assert sorted((r["left_seq"], r["right_seq"]) for r in found) == [(i, j) for i, j in np.argwhere(near)]
    assert all((r["left"], r["right"]) == (f"v{r['left_seq']}", f"v{r['right_seq']}") for r in found)


def test_wide_blocks_are_met_in_slabs(spark, monkeypatch):
    monkeypatch.setattr(cells, "PAIRS_AT_ONCE", 1000, raising=False)

    def match(there):
        def few(asking):
            assert len(asking) * len(there) <= 1000
            return pd.DataFrame({"pairs": [len(asking) * len(there)]})

        return few

    rows = vectors_of(spark, np.ones((300, 3))).select(F.col("seq").alias("id"), "embedding", F.lit("x").alias("block"))
    assert cells.meet(rows, rows, match, "pairs bigint").agg(F.sum("pairs")).first()[0] == 300 * 300


def test_pairs_are_not_joined_with_names(spark):
    plan = similar_pairs(vectors_of(spark, sample(1)), 0.2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("FlatMapGroupsInPandas")[0]


def test_few_rows_meet_the_pivots_at_once(spark):
    def bounded(left, right):
        assert len(left) <= 1000
        return cells.angles(left, right)

    rows = vectors_of(spark, np.abs(np.random.default_rng(2).normal(size=(3000, 3)))).select(F.col("seq").alias("id"), "embedding")
    pool, guests = cells.cells(rows, cells.constant_limit(rows, 0.01), bounded, 64)
    assert pool.count() == 3000 and guests.select("id").distinct().count() == 3000


def test_copies_add_no_pairs(spark, monkeypatch):
    seen = []
    original = rs.pairs_above
    monkeypatch.setattr(rs, "pairs_above", lambda v, *a: seen.append(v.count()) or original(v, *a))
    matrix = np.vstack([np.tile([1.0, 0.0], (50, 1)), [[0.0, 1.0]]])
    found = rs.cluster_names(vectors_of(spark, matrix), 0.88).collect()
    assert seen == [2]
    assert {r["canonical"] for r in found} == {"v0", "v50"}


def test_nearest(spark):
    generator = np.random.default_rng(4)
    matrix = generator.normal(size=(60, 3))
    df = vectors_of(spark, matrix).select(F.col("seq").alias("id"), "embedding")
    exact = np.linalg.norm(matrix[:, None] - matrix[None], axis=2)
    np.fill_diagonal(exact, np.inf)
    found = {}
    for r in nearest(df, 4, rows_per_block=9).collect():
        found.setdefault(r["id"], set()).add(r["neighbour"])
    assert found == {i: set(np.argsort(exact[i])[:4]) for i in range(60)}


def test_unique_names_in_first_seen_order(spark):
    edges = spark.createDataFrame([("Mr. A", "B", 2), ("C", "A", 1), (None, "B", 3)], "source string, target string, seq bigint")
    entities = spark.createDataFrame([("D", 1), ("C", 2)], "entity string, seq bigint")
    found = [r["name"] for r in rs.unique_names(edges, entities).orderBy("seq").collect()]
    assert found == ["C", "A", "B", "D"]
    assert rs.unique_names(edges, entities, normalize=False).count() == 5


def test_overrides_and_hops(spark):
    clusters = spark.createDataFrame([("a", "a", True), ("b", "a", False)], "alias string, canonical string, is_leader boolean")
    overrides = spark.createDataFrame([("b", "c"), ("c", "d"), ("x", "y"), ("y", "x")], "alias string, canonical string")
    mapping = rs.build_resolution_map(clusters, overrides)
    assert {r[0]: r[1] for r in mapping.collect()} == {"a": "a", "b": "c", "c": "d", "x": "y", "y": "x"}
    edges = spark.createDataFrame([("b", "Mr. b"), (None, "q")], "source string, target string")

    def names(**options):
        return sorted(map(tuple, rs.apply_resolution(edges, ["source", "target"], mapping, **options).collect()), key=str)

    # raw names are looked up and one hop is made
    assert names() == [("c", "Mr. b"), (None, "q")]
    assert names(normalize_before_lookup=True) == [("c", "c"), (None, "q")]
    assert names(transitive=True) == [("d", "Mr. b"), (None, "q")]


def test_cleaning_drops_loops_and_missing_ends(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("a", "a", 3), (None, "b", 4), ("a", None, 5)], "source string, target string, seq int")
    entities = spark.createDataFrame([("u", "a", "p", 2), ("u", "a", "q", 1)], "url string, entity string, entity_type string, seq int")
    kept, types = rs.clean_resolved(edges, entities)
    assert kept.collect() == [("a", "b")]
    assert [r["entity_type"] for r in types.collect()] == ["q"]


def test_default_vectors_are_close_for_similar_names(spark):
    names = spark.createDataFrame([("Volodymyr Zelensky", 0), ("Volodymyr Zelenskyy", 1), ("Berlin", 2)], "name string, seq bigint")
    pairs = similar_pairs(rs.name_embedding(names), 0.8).collect()
    assert [(r["left_seq"], r["right_seq"]) for r in pairs] == [(0, 1)]
