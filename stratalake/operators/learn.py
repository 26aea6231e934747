"""Boosted-tree training, grid search, run logging and batch scoring on pyspark.ml."""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.labels import stratified_folds
from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import store

# The tree settings to search, and the best point found.
FULL_GRID = {
    "maxDepth": [3, 5, 7],
    "stepSize": [0.1, 0.05, 0.01],
    "maxIter": [100, 200],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "1.0"],
    "minInstancesPerNode": [1, 5],
    "minInfoGain": [0.0, 1.0],
}
BEST_POINT = {
    "maxDepth": 5,
    "stepSize": 0.05,
    "maxIter": 100,
    "subsamplingRate": 1.0,
    "featureSubsetStrategy": "0.8",
    "minInstancesPerNode": 1,
    "minInfoGain": 0.0,
}
FOLDS = 10
SEED = 42


def classifier_pipeline(
    features: Sequence[str], label: str = "label", weight: str | None = "weight", **settings
) -> Pipeline:
    """Impute means, assemble the features and boost trees; settings default to ``BEST_POINT``."""
    filled = [f"{c}__filled" for c in features]
    trees = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED, **{**BEST_POINT, **settings})
    if weight:
        trees = trees.setWeightCol(weight)
    return Pipeline(
        stages=[
            Imputer(inputCols=list(features), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep"),
            trees,
        ]
    )


def as_numbers(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns as doubles, which the imputer asks for."""
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def train(df: DataFrame, features: Sequence[str], **options) -> PipelineModel:
    return classifier_pipeline(features, **options).fit(as_numbers(df, features))


def param_grid(pipeline: Pipeline, grid: Mapping[str, Sequence] = FULL_GRID) -> list[dict]:
    """Every combination of the listed tree settings as pyspark.ml parameter maps."""
    trees = pipeline.getStages()[-1]
    names = list(grid)
    return [
        {trees.getParam(n): v for n, v in zip(names, point, strict=True)}
        for point in itertools.product(*[grid[n] for n in names])
    ]


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    grid: Mapping[str, Sequence] = FULL_GRID,
    folds: int = FOLDS,
    parallelism: int = 4,
    label: str = "label",
    weight: str | None = "weight",
    key: str | Sequence[str] | None = None,
    **settings,
) -> CrossValidatorModel:
    """Cross-validated search for the highest ROC AUC.

    Folds are stratified and repeatable (see :func:`stratified_folds`): every fold holds each class in its share, so each has an AUC as soon as a class
    has as many rows as there are folds. Rows of one ``key`` stay together. Rows without label take no part.
    """
    pipeline = classifier_pipeline(features, label=label, weight=weight, **settings)
    dealt = stratified_folds(df.filter(F.col(label).isNotNull()), label, key, folds, out="_fold")
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=param_grid(pipeline, grid),
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    # Written once: every model reads its folds, and none deals them again.
    return search.fit(store(as_numbers(dealt, features), "folds"))


def grid_results(model: CrossValidatorModel, spark) -> DataFrame:
    """One row per grid point with its settings and mean AUC."""
    rows = [
        (i, json.dumps({p.name: v for p, v in point.items()}, sort_keys=True), float(auc))
        for i, (point, auc) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True))
    ]
    return literal_dim(spark, rows, "point int, settings string, mean_auc double")


def score_with(model, df: DataFrame, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Add ``probability`` of class 1 and ``prediction``; NULL where every feature is missing."""
    known = F.coalesce(*[F.col(c).cast("double") for c in features]).isNotNull()
    numeric = as_numbers(df.withColumn("_known", known), features)
    scored = model.transform(numeric).withColumn(
        "probability", F.when(F.col("_known"), vector_to_array("probability")[1])
    )
    return scored.select(
        *df.columns,
        "probability",
        F.when(F.col("probability").isNotNull(), (F.col("probability") > threshold).cast("int")).alias("prediction"),
    )


def log_run(metrics: DataFrame, run_id: str, params: Mapping, path: str) -> DataFrame:
    """Append one run's parameters and one-row metrics as (run_id, kind, name, value) and return the log."""
    spark = metrics.sparkSession
    entries = [
        F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        for c in metrics.columns
    ] + [
        F.struct(F.lit("param").alias("kind"), F.lit(k).alias("name"), F.lit(str(v)).alias("value"))
        for k, v in params.items()
    ]
    rows = metrics.select(F.lit(run_id).alias("run_id"), F.inline(F.array(*entries)))
    rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
