import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsweave.operators import aggregates as ag
from newsweave.operators import distribution
from newsweave.operators import filters as fl
from newsweave.operators import joins as jn
from newsweave.operators import ordering as od
from newsweave.operators.distribution import exact_percentiles, running_totals
from newsweave.session import work_path
from newsweave.sources import tables as tb

TEXTS = [(1, 'say "hi",\nthen go', 0.5), (2, None, None), (3, "plain", 2.0)]


def test_csv_keeps_breaks_and_quotes(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string, x double")
    path = work_path(spark, "csv")
    tb.write_csv(df, path)
    assert sorted(tb.read_csv(spark, path, "id int, text string, x double").collect()) == sorted(df.collect())
    assert tb.read_csv(spark, path).dtypes == [("id", "int"), ("text", "string"), ("x", "double")]


def test_csv_row_index_is_dropped(spark, tmp_path):
    file = tmp_path / "indexed.csv"
    file.write_text(",a,b\n0,x,1\n1,y,2\n")
    assert sorted(map(tuple, tb.read_csv(spark, str(file)).collect())) == [("x", 1), ("y", 2)]


def test_append_and_snapshot(spark):
    path = work_path(spark, "out")
    for n, stamp in enumerate(["a_1", "a_2", "a_2"]):
        batch = spark.createDataFrame([(n,)], "n int")
        tb.append_results(batch, f"{path}/master")
        tb.snapshot(batch, f"{path}/copies", stamp)
    assert sorted(r.n for r in spark.read.parquet(f"{path}/master").collect()) == [0, 1, 2]
    assert sorted(map(tuple, spark.read.parquet(f"{path}/copies").collect())) == [(0, "a_1"), (2, "a_2")]
    with pytest.raises(ValueError):
        tb.snapshot(spark.range(1), path, "../x")


def test_stacking_and_defaults(spark):
    left = tb.flag_source(spark.createDataFrame([(1,)], "a int"), {"us": 1, "fr": 0})
    right = spark.createDataFrame([(0, 2)], "us int, a int")
    assert sorted(map(tuple, tb.stack_tables([left, right]).select("a", "us", "fr").collect()), key=str) == [(1, 1, 0), (2, 0, None)]
    assert tb.default_column(right, "a", 5).collect() == right.collect()
    assert tb.default_column(right, "language", "en").first()["language"] == "en"


def test_spread_leaves_wide_scans_alone(spark):
    assert tb.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 8
    assert tb.spread(spark.range(0, 100, 1, 16)).rdd.getNumPartitions() == 16


def test_keep_one_treats_null_as_a_key(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, "p"), (4, None, "q")], "seq int, k string, v string")
    assert sorted(map(tuple, od.keep_one(df, ["k"], "seq", "last").collect())) == [(2, "a", None), (4, None, "q")]
    assert sorted(map(tuple, od.keep_one(df, ["k"], "seq", "first").collect())) == [(1, "a", "x"), (3, None, "p")]


def test_duplicates_of_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(od, "COPIES_PER_STEP", 7)
    df = spark.createDataFrame([("h", None)] * 50 + [("x", 1), ("y", 2), ("y", 2)], "a string, b int")
    assert od.duplicate_count(df).first()[0] == 50
    found = sorted((r["a"] for r in od.duplicate_rows(df).collect()))
    assert found == ["h"] * 50 + ["y"] * 2
    assert od.duplicate_count(df.limit(0)).first()[0] == 0


def test_collapse_last_writer(spark):
    df = spark.createDataFrame([("b", "a", "N", 1), ("a", "b", "F", 2), ("a", "b", "H", 3), ("a", None, "H", 4)], "source string, target string, sentiment string, seq int")
    assert sorted(map(tuple, od.collapse_edges(df).collect())) == [("a", "b", "H", 3), ("b", "a", "N", 1)]
    assert [tuple(r) for r in od.collapse_edges(df, directed=False).collect()] == [("a", "b", "H", 3)]


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("s", "t", v) for v in "baba"] + [("s", "u", None)], "source string, target string, sentiment string")
    assert [tuple(r) for r in jn.dominant_sentiment(df).collect()] == [("s", "t", "a")]


def test_reversed_pairs_find_no_sentiment(spark):
    graph = spark.createDataFrame([("a", "b")], "src string, dst string")
    edges = spark.createDataFrame([("b", "a", "HOSTILE")], "source string, target string, sentiment string")
    assert jn.edge_sentiment(graph, edges).first()["sentiment"] == "neutral"


def test_join_suffixes(spark):
    left = spark.createDataFrame([("u", 1, 2)], "url string, date int, a int")
    right = spark.createDataFrame([("u", 3, 4)], "url string, date int, b int")
    assert set(jn.join_on_key(left, right).columns) == {"url", "date_x", "a", "date_y", "b"}


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(0,), (499,), (500,), (1500,), (None,)], "n int")
    found = sorted(map(tuple, ag.histogram(df, "n", 500).collect()))
    assert found == [(0, 500, 2), (500, 1000, 1), (1000, 1500, 1)]
    assert sum(np.histogram([0, 499, 500, 1500], bins=range(0, 2000, 500))[0]) == 4
    assert ag.histogram(df.limit(0), "n", 500).count() == 0


def test_min_max_of_a_constant(spark):
    assert {r["scaled"] for r in ag.min_max_scale(spark.createDataFrame([(3,), (3,)], "v int"), "v", 10, 30).collect()} == {10.0}


def test_long_alias_lists_are_split_whole(spark):
    mapping = spark.createDataFrame([(f"n{i}", "hot") for i in range(100)] + [("a", "b"), ("c", "b"), ("d", "d")], "alias string, canonical string")
    found = ag.clusters_by_canonical(mapping, names_per_part=10).collect()
    assert sorted(n for r in found if r["canonical"] == "hot" for n in r["aliases"]) == sorted(f"n{i}" for i in range(100))
    assert max(len(r["aliases"]) for r in found) < 40
    assert [r["aliases"] for r in found if r["canonical"] == "b"] == [["a", "c"]]


@pytest.mark.parametrize("rows_per_range", [100_000, 50])
def test_percentiles_and_totals_under_skew(spark, rows_per_range):
    generator = np.random.default_rng(7)
    values = np.concatenate([np.full(400, 0.25), generator.normal(size=797), [0.25, 5.0, 5.0]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    shares = [0.0, 0.1, 0.333, 0.5, 0.9, 0.97, 1.0]
    found = [r["value"] for r in exact_percentiles(df, "v", shares, rows_per_range).orderBy("share").collect()]
    assert found == pytest.approx(list(np.percentile(values, [100 * s for s in shares])))
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    for descending in (False, True):
        rows = running_totals(counts, "v", ["n"], descending, rows_per_range).orderBy(F.desc("v") if descending else "v").collect()
        assert [r["cum_n"] for r in rows] == list(np.cumsum([r["n"] for r in rows]))


def test_filters(spark):
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame(
        [("Ann", "Bob", "F", day, "US"), ("bob", "Cy.", "H", None, None), (None, "Ann", "F", day, "french")],
        "source string, target string, sentiment string, date date, article_source string",
    )
    assert fl.equals_or_all(df, "sentiment").count() == 3
    assert fl.date_range(df, "2024-01-01", None).count() == 3
    assert fl.date_range(df, "2024-01-01", "2024-01-02").count() == 2
    assert fl.search_edges(df, "BOB").count() == 2
    assert fl.search_edges(df, "bob", "outgoing").count() == 1
    assert fl.search_edges(df, "ann", "incoming").count() == 1
    assert fl.search_edges(df, "cy.", mode="literal").count() == 1
    assert fl.search_edges(df, "b.b").count() == 2
    assert fl.from_source(df, "us").count() == 1
    assert fl.from_source(df, ["us", "French"]).count() == 2
    assert fl.from_source(df, "All").count() == 3
    assert fl.drop_self_loops(df).count() == 2


def test_duplicates_and_nulls_without_moving_texts(spark):
    """Null and empty strings differ; a repeated row counts once less than its copies, in any column type."""
    rows = [("a", 1, 0.5), ("a", 1, 0.5), ("a", 1, 0.5), (None, 1, None), (None, 1, None), ("", 1, None), ("a", 2, 0.5)]
    df = spark.createDataFrame(rows, "text string, n int, x double")
    assert od.duplicate_count(df).first()[0] == len(rows) - len(set(rows)) == 3
    assert od.duplicate_count(df.limit(0)).first()[0] == 0
    shown = df.withColumn("text", ag.presence("text"))
    assert {tuple(r) for r in ag.null_profile(shown).collect()} == {("text", 2), ("n", 0), ("x", 3)}
