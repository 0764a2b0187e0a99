"""Evaluation of scored rows (y, prob): each function reduces the scores once and works on the small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsweave.operators.distribution import exact_percentiles, running_totals
from newsweave.session import scalar


def thresholds(low: float = 0.01, high: float = 0.99, n: int = 100) -> list[float]:
    return [low + i * ((high - low) / (n - 1)) for i in range(n)]


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def threshold_sweep(scored: DataFrame, low: float = 0.01, high: float = 0.99, n: int = 100) -> DataFrame:
    """threshold, tp, fp, fn, precision, recall, f1 for ``prob >= threshold`` at n equally spaced thresholds.

    A score is replaced by the number of thresholds it reaches; all thresholds are then read off at most n+1
    counts, in one pass over the scores.
    """
    marks = F.array(*[F.lit(t) for t in thresholds(low, high, n)])
    reached = F.size(F.filter(marks, lambda t: t <= F.col("prob")))
    counts = scored.groupBy(reached.alias("step")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    positives = F.coalesce(scalar(counts, F.sum("pos")), F.lit(0))
    steps = scored.sparkSession.range(1).select(F.posexplode(marks).alias("at", "threshold")).withColumn("step", F.col("at") + 1)
    above = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    summed = steps.join(counts, "step", "left").select(
        "threshold",
        F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return summed.withColumn("fn", positives - tp).withColumns(
        {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "f1": _f1(tp, fp, fn)}
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """First threshold of highest F1."""
    return sweep.orderBy(F.desc("f1"), "threshold").limit(1)


def confusion_matrix(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """y, yhat, n and the share of the row's class; all four cells."""
    limit = F.lit(threshold) if isinstance(threshold, float) else threshold
    counts = scored.groupBy("y", (F.col("prob") >= limit).cast("int").alias("yhat")).agg(F.count(F.lit(1)).alias("n"))
    cells = scored.sparkSession.range(4).select((F.col("id") / 2).cast("int").alias("y"), (F.col("id") % 2).cast("int").alias("yhat"))
    filled = cells.join(counts, ["y", "yhat"], "left").select("y", "yhat", F.coalesce("n", F.lit(0)).alias("n"))
    return filled.withColumn("ratio", _ratio(F.col("n"), F.sum("n").over(Window.partitionBy("y"))))


def _per_score(scored: DataFrame) -> DataFrame:
    return scored.groupBy("prob").agg(
        F.sum((F.col("y") == 1).cast("bigint")).alias("pos"), F.sum((F.col("y") == 0).cast("bigint")).alias("neg")
    )


def roc_curve(scored: DataFrame) -> DataFrame:
    """fpr, tpr, threshold at every distinct score, and the origin (null threshold)."""
    running = running_totals(_per_score(scored), "prob", ["pos", "neg"], descending=True)
    pos, neg = scalar(running, F.max("cum_pos")), scalar(running, F.max("cum_neg"))
    points = running.select(
        (F.col("cum_neg") / neg).alias("fpr"), (F.col("cum_pos") / pos).alias("tpr"), F.col("prob").alias("threshold")
    )
    origin = scored.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(origin)


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the curve as the share of (positive, negative) pairs in the right order, ties counting half."""
    running = running_totals(_per_score(scored), "prob", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return running.agg((won / (F.sum("pos").cast("double") * F.sum("neg"))).alias("auc"))


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """bin, mean_prob, frac_positive, n over quantile bins; a score on an edge falls in the lower bin."""
    shares = [i / bins for i in range(1, bins)]
    edges = [r["value"] for r in exact_percentiles(scored, "prob", shares).orderBy("share").collect()]
    number = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("prob")))
    return scored.groupBy(number.alias("bin")).agg(
        F.avg("prob").alias("mean_prob"), F.avg("y").alias("frac_positive"), F.count(F.lit(1)).alias("n")
    )


def score_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Counts and within-class densities over equal bins spanning all scores; the last bin is closed."""
    low, high = scalar(scored, F.min("prob")), scalar(scored, F.max("prob"))
    width = (high - low) / bins
    number = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("prob") - low) / width), F.lit(bins - 1)))
    counts = scored.groupBy("y", number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("y"))
    return counts.withColumn("density", F.col("n") / (total * width))


def classification_report(scored: DataFrame, threshold: float) -> DataFrame:
    """label, precision, recall, f1, support per class, with accuracy, macro and weighted averages."""
    hit = (F.col("prob") >= threshold).cast("int")
    true, false = F.col("y") == 1, F.col("y") == 0
    cells = scored.agg(
        F.count_if(true & (hit == 1)).alias("tp"),
        F.count_if(false & (hit == 1)).alias("fp"),
        F.count_if(true & (hit == 0)).alias("fn"),
        F.count_if(false & (hit == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    measures = cells.select(
        _ratio(tn, tn + fn).alias("p0"), _ratio(tn, tn + fp).alias("r0"), _f1(tn, fn, fp).alias("f0"), (tn + fp).alias("s0"),
        _ratio(tp, tp + fp).alias("p1"), _ratio(tp, tp + fn).alias("r1"), _f1(tp, fp, fn).alias("f1"), (tp + fn).alias("s1"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )

    def row(label, precision, recall, f1, support):
        return F.struct(
            F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), support.alias("support")
        )

    c = F.col
    everyone = c("s0") + c("s1")

    def macro(name):
        return (c(f"{name}0") + c(f"{name}1")) / 2

    def weighted(name):
        return _ratio(c(f"{name}0") * c("s0") + c(f"{name}1") * c("s1"), everyone)

    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("s0")),
        row("1", c("p1"), c("r1"), c("f1"), c("s1")),
        row("accuracy", c("accuracy"), c("accuracy"), c("accuracy"), everyone),
        row("macro avg", macro("p"), macro("r"), macro("f"), everyone),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), everyone),
    )
    return measures.select(F.explode(rows).alias("r")).select("r.*")


def rmse(scored: DataFrame, by: str = "split") -> DataFrame:
    """Root mean squared error of the probability per split."""
    error = F.col("y") - F.col("prob")
    return scored.groupBy(by).agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def leaderboard(runs: DataFrame, order: str = "run") -> DataFrame:
    """Latest run per model."""
    rest = [c for c in runs.columns if c not in ("model", order)]
    return runs.groupBy("model").agg(F.max_by(F.struct(*rest), order).alias("r")).select("model", "r.*")


def diagnostics(scored: DataFrame, model: str) -> DataFrame:
    """One summary row: model, threshold, train_rmse, test_rmse, auc, f1. Needs ``split`` train or valid."""
    valid = scored.filter("split = 'valid'")
    best = best_threshold(threshold_sweep(valid))
    errors = rmse(scored)
    return best.select(
        F.lit(model).alias("model"),
        "threshold",
        scalar(errors.filter("split = 'train'"), F.max("rmse")).alias("train_rmse"),
        scalar(errors.filter("split = 'valid'"), F.max("rmse")).alias("test_rmse"),
        roc_auc(valid).scalar().alias("auc"),
        "f1",
    )
