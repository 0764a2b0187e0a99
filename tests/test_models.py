import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from newsweave.operators import modelling as md
from newsweave.operators import scoring as sc


def scores(spark, seed=1, n=300):
    generator = np.random.default_rng(seed)
    y = generator.integers(0, 2, n)
    prob = np.round(np.clip(0.3 * y + generator.normal(0.35, 0.2, n), 0, 1), 2)
    prob[: n // 3] = 0.5  # a third share one score
    return y, prob, spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, prob)], "y int, prob double").repartition(4)


def f1_of(y, hit):
    tp, fp, fn = sum(hit & (y == 1)), sum(hit & (y == 0)), sum(~hit & (y == 1))
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def test_sweep_and_best_threshold(spark):
    y, prob, df = scores(spark)
    marks = np.linspace(0.01, 0.99, 100)
    expected = [f1_of(y, prob >= t) for t in marks]
    found = sc.threshold_sweep(df).orderBy("threshold").collect()
    assert [r["threshold"] for r in found] == pytest.approx(list(marks))
    assert [r["f1"] for r in found] == pytest.approx(expected)
    best = sc.best_threshold(sc.threshold_sweep(df)).first()
    assert best["threshold"] == pytest.approx(marks[int(np.argmax(expected))])


def test_auc_and_roc(spark):
    y, prob, df = scores(spark, 2)
    pairs = [(a > b) + 0.5 * (a == b) for a in prob[y == 1] for b in prob[y == 0]]
    assert sc.roc_auc(df).first()[0] == pytest.approx(np.mean(pairs))
    curve = sorted((r["fpr"], r["tpr"]) for r in sc.roc_curve(df).collect())
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0) and len(curve) == len(set(prob)) + 1
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(np.mean(pairs))


def test_calibration_puts_edges_in_the_lower_bin(spark):
    y, prob, df = scores(spark, 3)
    edges = np.percentile(prob, np.arange(10, 100, 10))
    bins = np.searchsorted(edges, prob)
    found = {r["bin"]: r for r in sc.calibration(df).collect()}
    assert set(found) == set(bins)
    for b in set(bins):
        assert found[b]["n"] == sum(bins == b)
        assert found[b]["mean_prob"] == pytest.approx(prob[bins == b].mean())
        assert found[b]["frac_positive"] == pytest.approx(y[bins == b].mean())


def test_histogram_density(spark):
    y, prob, df = scores(spark, 4)
    found = sc.score_histogram(df).collect()
    width = (prob.max() - prob.min()) / 30
    for c in (0, 1):
        assert sum(r["n"] for r in found if r["y"] == c) == sum(y == c)
        assert sum(r["density"] * width for r in found if r["y"] == c) == pytest.approx(1.0)


def test_report_and_matrix(spark):
    y, prob, df = scores(spark, 5)
    hit = prob >= 0.5
    report = {r["label"]: r for r in sc.classification_report(df, 0.5).collect()}
    assert report["1"]["f1"] == pytest.approx(f1_of(y, hit)) and report["0"]["f1"] == pytest.approx(f1_of(1 - y, ~hit))
    assert report["accuracy"]["precision"] == pytest.approx(np.mean(hit == y))
    cells = {(r["y"], r["yhat"]): r for r in sc.confusion_matrix(df, 0.5).collect()}
    assert cells[1, 1]["n"] == sum(hit & (y == 1)) and len(cells) == 4
    assert cells[0, 0]["ratio"] + cells[0, 1]["ratio"] == pytest.approx(1.0)
    never = {(r["y"], r["yhat"]): r["n"] for r in sc.confusion_matrix(df, 2.0).collect()}
    assert never[1, 1] == 0


def test_split_counts_are_exact(spark):
    df = spark.range(1013).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    split = md.stratified_split(df, "y", "id")
    counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert counts[0, "valid"] + counts[1, "valid"] == 203
    assert counts[1, "valid"] == 29 and counts[1, "train"] == 116
    again = md.stratified_split(df.repartition(5), "y", "id")
    assert split.exceptAll(again).count() == 0


def test_smote_fills_the_minority_only(spark):
    generator = np.random.default_rng(6)
    rows = [(i, int(i >= 20), [float(v) for v in generator.normal(size=3)]) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, y int, features array<double>")
    found = md.smote(df, rows_per_block=8)
    counts = {(r["y"], r["synthetic"]): r["count"] for r in found.groupBy("y", "synthetic").count().collect()}
    assert counts == {(0, False): 20, (1, False): 80, (0, True): 60}
    points = np.array([r[2] for r in rows[:20]])
    for r in found.filter("synthetic").collect():
        start = points[r["id"]]
        order = np.argsort(np.linalg.norm(points - start, axis=1))[1:6]
        along = [np.linalg.norm(np.cross(points[j] - start, np.array(r["features"]) - start)) for j in order]
        assert min(along) < 1e-6


def labelled(spark):
    generator = np.random.default_rng(8)
    rows = []
    for i in range(160):
        y = i % 2
        rows.append((i, float(y), float(generator.normal(2 * y)), float(generator.normal()), "ab"[int(generator.integers(2))]))
    return md.stratified_split(spark.createDataFrame(rows, "id bigint, y double, a double, b double, c string"), "y", "id")


def test_grid_search_and_summary(spark):
    data = labelled(spark)
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=10)
    stages = [*md.feature_stages(["a", "b"], ["c"]), *md.scaling_stages(top_k=2, components=2), model]
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 1.0]).build()
    best, scored, summary = md.run_model("lr", data, stages, grid, folds=3)
    row = summary.first()
    assert row["model"] == "lr" and row["auc"] > 0.8 and 0 < row["test_rmse"] < 0.6
    assert scored.count() == 160
    corrected = md.calibrate(scored).agg(F.min("calibrated"), F.max("calibrated")).first()
    assert corrected[0] >= 0 and corrected[1] <= 1


@pytest.mark.parametrize("family", ["random forest", "neural network", "boosted trees"])
def test_model_families(spark, family):
    data = labelled(spark)
    model = md.model_families(inputs=2)[family]
    best, scored = md.grid_search(data, [*md.feature_stages(["a", "b"]), *md.scaling_stages(), model], [{}], folds=2)
    assert sc.roc_auc(scored.filter("split = 'valid'")).first()[0] > 0.7


def test_leaderboard_takes_the_latest_run(spark):
    runs = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.7), ("b", 1, 0.1)], "model string, run int, rmse double")
    assert sorted(map(tuple, sc.leaderboard(runs).collect())) == [("a", 0.7), ("b", 0.1)]
