"""Queries over labelled and scored rows, and model runs on article features."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from newsweave.functions import text as tx
from newsweave.functions import dates as dx
from newsweave.operators import modelling as md
from newsweave.operators import scoring as sc
from newsweave.plans.article_queries import _days, token_sql
from newsweave.plans.fixture_sql import ARTICLES, SCORED, with_
from newsweave.session import cut
from newsweave.sources import fixtures as fx
from newsweave.sources.tables import stack_tables

THRESHOLD = 0.5


def valid(spark, sf):
    return fx.scored(spark, sf).filter("split = 'valid'")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def runs(spark, sf):
    """Error measures of three imagined models, run twice each: probabilities shrunk by a factor."""
    scored = fx.scored(spark, sf)
    parts = []
    for run, (model, factor) in enumerate([("a", 1.0), ("b", 0.5), ("a", 0.75), ("c", 0.25), ("b", 0.875)]):
        error = F.col("y") - F.col("prob") * F.lit(factor)
        parts.append(
            scored.agg(F.sqrt(F.avg(error * error)).alias("rmse")).select(F.lit(model).alias("model"), F.lit(run).alias("run"), "rmse")
        )
    return stack_tables(parts)


def labelled_features(spark, sf):
    """Numeric and categorical article features with the label, labelled articles only."""
    articles = fx.articles(spark, sf).filter("relevance_text is not null")
    ts = F.col("datetime")
    return articles.select(
        F.col("seq").alias("id"),
        F.col("relevance_text").cast("double").alias("y"),
        F.coalesce(dx.days_until(ts, dx.US_ELECTION), F.lit(0)).cast("double").alias("days"),
        tx.word_count(F.col("text")).cast("double").alias("words"),
        F.length("text").cast("double").alias("chars"),
        F.col("is_us_election").cast("double").alias("us"),
        F.col("language"),
    )


NUMERIC = ["days", "words", "chars", "us"]


def searched(spark, sf):
    data = cut(md.stratified_split(labelled_features(spark, sf), "y", "id"))
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=20)
    stages = [*md.feature_stages(NUMERIC, ["language"]), *md.scaling_stages(), model]
    grid = ParamGridBuilder().addGrid(model.regParam, [0.01, 0.1]).build()
    return md.run_model("logistic regression", data, stages, grid, identifier="id")


def balanced(spark, sf):
    rows = labelled_features(spark, sf).select("id", F.col("y").cast("int").alias("y"), F.array(*NUMERIC).alias("features"))
    return md.smote(rows, seed=42).select("id", "y", F.array_join(F.transform("features", lambda v: F.round(v, 4)), ",").alias("features"), "synthetic")


QUERIES = {
    "rmse": lambda s, d: rounded(sc.rmse(fx.scored(s, d)), "rmse"),
    "class_balance": lambda s, d: rounded(md.class_balance(fx.scored(s, d)), "ratio"),
    "threshold_sweep": lambda s, d: rounded(sc.threshold_sweep(valid(s, d)), "threshold", "precision", "recall", "f1"),
    "best_threshold": lambda s, d: rounded(sc.best_threshold(sc.threshold_sweep(valid(s, d))).select("threshold", "f1"), "threshold", "f1"),
    "confusion_matrix": lambda s, d: rounded(
        sc.confusion_matrix(valid(s, d), sc.best_threshold(sc.threshold_sweep(valid(s, d))).select("threshold").scalar()), "ratio"
    ),
    "roc_curve": lambda s, d: rounded(sc.roc_curve(valid(s, d)), "fpr", "tpr", "threshold"),
    "roc_auc": lambda s, d: rounded(sc.roc_auc(valid(s, d)), "auc"),
    "calibration": lambda s, d: rounded(sc.calibration(valid(s, d)), "mean_prob", "frac_positive"),
    "score_histogram": lambda s, d: rounded(sc.score_histogram(valid(s, d)), "density"),
    "classification_report": lambda s, d: rounded(sc.classification_report(valid(s, d), THRESHOLD), "precision", "recall", "f1"),
    "leaderboard": lambda s, d: rounded(sc.leaderboard(runs(s, d)), "rmse"),
    "model_summary": lambda s, d: rounded(
        sc.diagnostics(fx.scored(s, d), "fixture"), "threshold", "train_rmse", "test_rmse", "auc", "f1"
    ),
    "stratified_split": lambda s, d: md.stratified_split(fx.scored(s, d).select("id", "y"), "y", "id"),
    "grid_search": lambda s, d: searched(s, d)[1].select("id", "y", "split", F.round("prob", 4).alias("prob")),
    "smote": balanced,
}

VALID = SCORED + ", valid AS (SELECT * FROM scored WHERE split = 'valid')"
SWEEP = VALID + """, marks AS (SELECT 0.01::DOUBLE + i * ((0.99::DOUBLE - 0.01::DOUBLE) / 99) AS threshold FROM (SELECT unnest(range(0, 100)) AS i)
), counted AS (
  SELECT threshold, count_if(y = 1 AND prob >= threshold)::BIGINT AS tp, count_if(y = 0 AND prob >= threshold)::BIGINT AS fp,
         count_if(y = 1 AND prob < threshold)::BIGINT AS fn
  FROM marks, valid GROUP BY threshold
), sweep AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall,
         CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f1
  FROM counted
), best AS (SELECT * FROM sweep ORDER BY f1 DESC, threshold LIMIT 1)"""
AUC = """(SELECT sum(CASE WHEN p.prob > n.prob THEN 1.0::DOUBLE WHEN p.prob = n.prob THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) / count(*)
  FROM valid p, valid n WHERE p.y = 1 AND n.y = 0)"""


def _report_row(label: str, p: str, r: str, f: str, s: str) -> str:
    return f"SELECT '{label}' AS label, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, {s} AS support FROM c"


ORACLE = {
    "rmse": with_(SCORED) + "SELECT split, round(sqrt(avg((y - prob) * (y - prob))), 6) AS rmse FROM scored GROUP BY split",
    "class_balance": with_(SCORED)
    + """SELECT split, y, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY split) AS DOUBLE), 6) AS ratio
FROM scored GROUP BY split, y""",
    "threshold_sweep": with_(SWEEP)
    + "SELECT round(threshold, 6) AS threshold, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM sweep",
    "best_threshold": with_(SWEEP) + "SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM best",
    "confusion_matrix": with_(SWEEP)
    + """, cells AS (
  SELECT a.y, b.yhat, (SELECT count(*) FROM valid v WHERE v.y = a.y AND CAST(v.prob >= (SELECT threshold FROM best) AS INTEGER) = b.yhat) AS n
  FROM (VALUES (0), (1)) a(y), (VALUES (0), (1)) b(yhat))
SELECT y, yhat, n, round(CASE WHEN sum(n) OVER (PARTITION BY y) > 0 THEN n / CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE) ELSE 0 END, 6) AS ratio
FROM cells""",
    "roc_curve": with_(VALID)
    + """SELECT round((SELECT count(*) FROM valid v WHERE v.y = 0 AND v.prob >= t.prob) / CAST((SELECT count(*) FROM valid WHERE y = 0) AS DOUBLE), 6) AS fpr,
  round((SELECT count(*) FROM valid v WHERE v.y = 1 AND v.prob >= t.prob) / CAST((SELECT count(*) FROM valid WHERE y = 1) AS DOUBLE), 6) AS tpr,
  round(t.prob, 6) AS threshold FROM (SELECT DISTINCT prob FROM valid) t
UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE, NULL""",
    "roc_auc": with_(VALID) + f"SELECT round({AUC}, 6) AS auc",
    "calibration": with_(VALID)
    + """, cuts AS (SELECT quantile_cont(prob, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM valid)
SELECT CAST(len(list_filter(e, lambda x: x < prob)) AS INTEGER) AS bin, round(avg(prob), 6) AS mean_prob,
  round(avg(y), 6) AS frac_positive, count(*) AS n FROM valid, cuts GROUP BY 1""",
    "score_histogram": with_(VALID)
    + """, spans AS (SELECT min(prob) AS lo, (max(prob) - min(prob)) / 30 AS w FROM valid)
SELECT y, CAST(least(floor((prob - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n,
  round(count(*) / (CAST(sum(count(*)) OVER (PARTITION BY y) AS DOUBLE) * any_value(w)), 6) AS density
FROM valid, spans GROUP BY 1, 2""",
    "classification_report": with_(VALID)
    + """, t AS (
  SELECT count_if(y = 1 AND prob >= 0.5)::DOUBLE AS tp, count_if(y = 0 AND prob >= 0.5)::DOUBLE AS fp,
         count_if(y = 1 AND prob < 0.5)::DOUBLE AS fn, count_if(y = 0 AND prob < 0.5)::DOUBLE AS tn FROM valid
), c AS (
  SELECT coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
         coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0, CAST(tn + fp AS BIGINT) AS s0,
         coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
         coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0) AS f1, CAST(tp + fn AS BIGINT) AS s1,
         (tp + tn) / (tp + tn + fp + fn) AS acc FROM t
)
"""
    + " UNION ALL ".join(
        [
            _report_row("0", "p0", "r0", "f0", "s0"),
            _report_row("1", "p1", "r1", "f1", "s1"),
            _report_row("accuracy", "acc", "acc", "acc", "s0 + s1"),
            _report_row("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s0 + s1"),
            _report_row(
                "weighted avg", "(p0 * s0 + p1 * s1) / (s0 + s1)", "(r0 * s0 + r1 * s1) / (s0 + s1)", "(f0 * s0 + f1 * s1) / (s0 + s1)", "s0 + s1"
            ),
        ]
    ),
    "leaderboard": with_(SCORED)
    + """SELECT model, round(sqrt(avg((y - prob * factor) * (y - prob * factor))), 6) AS rmse
FROM scored, (VALUES ('a', 0.75::DOUBLE), ('b', 0.875::DOUBLE), ('c', 0.25::DOUBLE)) m(model, factor) GROUP BY model""",
    "model_summary": with_(SWEEP)
    + f"""SELECT 'fixture' AS model, round(threshold, 6) AS threshold,
  (SELECT round(sqrt(avg((y - prob) * (y - prob))), 6) FROM scored WHERE split = 'train') AS train_rmse,
  (SELECT round(sqrt(avg((y - prob) * (y - prob))), 6) FROM valid) AS test_rmse, round({AUC}, 6) AS auc, round(f1, 6) AS f1 FROM best""",
    "stratified_split": with_(SCORED)
    + """, sizes AS (SELECT y, count(*) AS n FROM scored GROUP BY y
), wanted AS (SELECT CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS BIGINT) AS w, CAST(sum(n) AS BIGINT) AS total FROM sizes
), shares AS (
  SELECT y, n * w // total AS base, row_number() OVER (ORDER BY n * w % total DESC, y) AS place, w FROM sizes, wanted
), quotas AS (SELECT y, base + CASE WHEN place <= w - (SELECT sum(base) FROM shares) THEN 1 ELSE 0 END AS quota FROM shares
), ranked AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS r FROM scored)
SELECT id, ranked.y, CASE WHEN r <= quota THEN 'valid' ELSE 'train' END AS split FROM ranked JOIN quotas ON quotas.y = ranked.y""",
    "smote": with_(ARTICLES + ", " + f"""features AS (
  SELECT seq AS id, CAST(relevance_text AS INTEGER) AS y, [
    CAST(coalesce({_days("2024-11-05")}, 0) AS DOUBLE), CAST(coalesce(len({token_sql('text')}), 0) AS DOUBLE),
    CAST(length(text) AS DOUBLE), CAST(is_us_election AS DOUBLE)] AS f
  FROM articles WHERE relevance_text IS NOT NULL
), sizes AS (SELECT y, count(*) AS n FROM features GROUP BY y
), rare AS (SELECT y, n, (SELECT max(n) FROM sizes) - n AS needed FROM sizes ORDER BY n, y LIMIT 1
), minority AS (SELECT id, f, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR))) AS place FROM features WHERE y = (SELECT y FROM rare)
), near AS (
  SELECT a.id, b.id AS neighbour, b.f AS other,
    row_number() OVER (PARTITION BY a.id ORDER BY list_sum(list_transform(list_zip(a.f, b.f), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), b.id) - 1 AS rank
  FROM minority a JOIN minority b ON a.id <> b.id
), copies AS (
  SELECT id, f, unnest(range(1, CAST(needed // n + CASE WHEN place <= needed % n THEN 1 ELSE 0 END + 1 AS BIGINT))) AS copy, least(5, n - 1) AS available FROM minority, rare
), drawn AS (SELECT *, md5('42:' || CAST(id AS VARCHAR) || ':' || CAST(copy AS VARCHAR)) AS d FROM copies
), made AS (
  SELECT d.id, list_transform(list_zip(f, other), lambda p: p[1] + (p[2] - p[1]) * (CAST(CAST('0x' || d.d[9:16] AS BIGINT) % 1048576 AS DOUBLE) / 1048576)) AS f
  FROM drawn d JOIN near n ON n.id = d.id AND n.rank = CAST('0x' || d.d[1:8] AS BIGINT) % available
), everything AS (SELECT id, y, f, false AS synthetic FROM features UNION ALL SELECT id, (SELECT y FROM rare), f, true FROM made)
SELECT id, y, array_to_string(list_transform(f, lambda v: round(v, 4)), ',') AS features, synthetic FROM everything"""),
}
