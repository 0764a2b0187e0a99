"""Splits, feature assembly, model families, grid search and minority oversampling on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    PCA,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsweave.operators.scoring import diagnostics
from newsweave.operators.similarity import ROWS_PER_BLOCK, nearest
from newsweave.session import cut

HASH_BUCKETS = 65_536
GAPS = 1 << 20  # places between a row and its neighbour


def hash_key(identifier: str, seed: int) -> Column:
    """Hex text that orders rows pseudo-randomly but reproducibly."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(identifier).cast("string")))


def smallest_keys(df: DataFrame, strata: str, quotas: dict) -> dict:
    """Per stratum, the ``_key`` up to which exactly its quota of rows lies.

    Keys are counted by their first four hex digits; only the bucket the quota falls into is ranked, about
    1/65536 of the stratum's rows.
    """
    bucket = F.conv(F.substring("_key", 1, 4), 16, 10).cast("int")
    keyed = df.select(F.col(strata).alias("s"), "_key", bucket.alias("b"))
    counts = keyed.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    quota = F.lit(0)
    for value, wanted in quotas.items():
        quota = F.when(F.col("s") == value, F.lit(wanted)).otherwise(quota)
    up_to = F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    cuts = (
        counts.withColumns({"upto": up_to, "quota": quota})
        .filter("upto >= quota and upto - n < quota")
        .select("s", "b", (F.col("quota") - F.col("upto") + F.col("n")).alias("left"))
    )
    # one row per stratum
    ranked = keyed.join(F.broadcast(cuts), ["s", "b"]).withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("_key")))
    return {row["s"]: row["_key"] for row in ranked.filter(F.col("r") == F.col("left")).select("s", "_key").collect()}


def up_to_key(strata: str, keys: dict) -> Column:
    chosen = F.lit(False)
    for value, key in keys.items():
        chosen = F.when(F.col(strata) == value, F.col("_key") <= key).otherwise(chosen)
    return chosen


def stratified_split(df: DataFrame, label: str, identifier: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: ceil(test*n) rows are ``valid``, shared over the classes in proportion; the rest ``train``.

    The remaining places after rounding down go to the largest fractions. One row per class reaches the
    driver; rows themselves are decided by comparing a hash, without a shuffle.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    wanted = math.ceil(test * total)
    quotas = {value: n * wanted // total for value, n in sizes.items()}
    by_fraction = sorted(sizes, key=lambda value: (-(sizes[value] * wanted % total), value))
    for value in by_fraction[: wanted - sum(quotas.values())]:
        quotas[value] += 1
    keyed = df.withColumn("_key", hash_key(identifier, seed))
    keys = smallest_keys(keyed, label, quotas)
    split = F.when(up_to_key(label, keys), F.lit("valid")).otherwise(F.lit("train"))
    return keyed.withColumn("split", split).drop("_key")


def class_balance(df: DataFrame, label: str = "y") -> DataFrame:
    """Class counts and shares per split."""
    counts = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(Window.partitionBy("split")))


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = ()) -> list[Estimator]:
    """Index and encode categories, then assemble one vector."""
    stages = []
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        encoded = [f"{c}_vector" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
    else:
        encoded = []
    stages.append(VectorAssembler(inputCols=[*numeric, *encoded], outputCol="raw_features", handleInvalid="keep"))
    return stages


def scaling_stages(top_k: int | None = None, components: int | None = None, label: str = "y") -> list[Estimator]:
    """Standardise; optionally keep the top_k features by variance analysis and project on principal components."""
    stages = [StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True)]
    last = "scaled"
    if top_k:
        selector = UnivariateFeatureSelector(featuresCol=last, outputCol="selected", labelCol=label, selectionMode="numTopFeatures")
        stages.append(selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(top_k))
        last = "selected"
    if components:
        stages.append(PCA(k=components, inputCol=last, outputCol="components"))
        last = "components"
    stages.append(VectorAssembler(inputCols=[last], outputCol="features"))
    return stages


def model_families(inputs: int, label: str = "y", seed: int = 42) -> dict[str, Estimator]:
    """The classifier families by name."""
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "logistic regression": LogisticRegression(**common),
        "random forest": RandomForestClassifier(seed=seed, **common),
        "neural network": MultilayerPerceptronClassifier(layers=[inputs, 8, 2], seed=seed, **common),
        "boosted trees": GBTClassifier(seed=seed, **common),
    }


def grid_search(
    data: DataFrame,
    stages: Sequence[Estimator],
    grid: list[dict],
    label: str = "y",
    identifier: str = "id",
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
):
    """Cross-validate on the train split by ROC AUC, refit on all of it and score both splits.

    Returns (best model, scored rows with ``prob`` of class 1). Folds are fixed by a hash of the identifier.
    """
    fold = F.pmod(F.conv(F.substring(hash_key(identifier, seed + 1), 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")
    train = data.filter("split = 'train'").withColumn("_fold", fold)
    search = CrossValidator(
        estimator=Pipeline(stages=list(stages)),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    best = search.fit(train).bestModel
    return best, score(best, data)


def score(model, data: DataFrame) -> DataFrame:
    """Add the probability of class 1."""
    scored = model.transform(data).withColumn("prob", vector_to_array("probability")[1])
    return scored.select(*data.columns, "prob")


def calibrate(scored: DataFrame, label: str = "y") -> DataFrame:
    """Probabilities corrected by an isotonic fit on the train split."""
    fit = IsotonicRegression(featuresCol="prob", labelCol=label, predictionCol="calibrated").fit(scored.filter("split = 'train'"))
    return fit.transform(scored)


def run_model(name: str, data: DataFrame, stages: Sequence[Estimator], grid: list[dict], report: Callable = diagnostics, **search):
    """Search, score and summarise one model: (best model, scored rows, summary)."""
    model, scored = grid_search(data, stages, grid, **search)
    scored = cut(scored)
    return model, scored, report(scored, name)


def drawn_number(start: int) -> Column:
    """Eight hex digits of ``draw`` as a number."""
    return F.conv(F.substring("draw", start, 8), 16, 10).cast("bigint")


def smote(
    df: DataFrame,
    features: str = "features",
    label: str = "y",
    identifier: str = "id",
    k: int = 5,
    ratio: float = 1.0,
    seed: int = 42,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add synthetic rows of the rarest class until it holds ``ratio`` times the largest class.

    A synthetic row lies at a hash-chosen point between a minority row and one of its k nearest minority
    rows. Returns (identifier, label, features, synthetic).
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    rare = min(sizes, key=lambda value: (sizes[value], value))
    needed = max(0, round(ratio * max(sizes.values())) - sizes[rare])
    columns = [F.col(identifier), F.col(label), F.col(features)]
    original = df.select(*columns, F.lit(False).alias("synthetic"))
    if needed == 0 or sizes[rare] < 2:
        return original
    minority = df.filter(F.col(label) == rare).select(
        F.col(identifier).alias("id"), F.col(features).alias("embedding"), hash_key(identifier, seed).alias("_key"), F.lit(0).alias("_all")
    )
    minority = cut(minority)
    each, extra = divmod(needed, sizes[rare])
    one_more = up_to_key("_all", smallest_keys(minority, "_all", {0: extra})) if extra else F.lit(False)
    near = nearest(minority.select("id", "embedding"), k, rows_per_block)
    # k rows per id
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour")) - 1)
    available = min(k, sizes[rare] - 1)
    copies = F.lit(each) + F.when(one_more, F.lit(1)).otherwise(F.lit(0))
    drawn = (
        minority.withColumn("copies", copies)
        .filter("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), "id", "copy")))
        .withColumn("rank", (drawn_number(1) % available).cast("int"))
        .withColumn("gap", (drawn_number(9) % GAPS) / F.lit(float(GAPS)))
    )
    others = minority.select(F.col("id").alias("neighbour"), F.col("embedding").alias("other"))
    between = F.zip_with("embedding", "other", lambda a, b: a + (b - a) * F.col("gap"))
    made = drawn.join(near, ["id", "rank"]).join(others, "neighbour").select(
        F.col("id").alias(identifier),
        F.lit(rare).alias(label),
        between.cast(df.schema[features].dataType).alias(features),
        F.lit(True).alias("synthetic"),
    )
    return original.unionByName(made)
