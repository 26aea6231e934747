"""Training set from a feature panel: thresholds, label, split and weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.evaluate import eval_auc, eval_confusion
from stratalake.operators.labels import class_balance, label_rules, split_stratified
from stratalake.operators.learn import FOLDS, grid_search, log_run, save_model, score_with, train
from stratalake.operators.ordered import exact_quantiles
from stratalake.sources.scratch import store

# What makes a month a bad one.
LOW_QUANTILE, HIGH_QUANTILE, QUANTILE_ERROR = 0.33, 0.66, 0.01
COLD_BELOW, HOT_ABOVE, RAINY_ABOVE = 5, 30, 10
THRESHOLD_COLUMNS = ["aire_pct_buena", "apt_availability_score"]
TEST_SHARE = 0.2


def low_thresholds(panel: DataFrame, columns: Sequence[str], prob: float, rel_err: float) -> dict[str, float | None]:
    """One quantile per column, NULL and NaN ignored: sketched in one pass, or exact for ``rel_err`` 0."""
    if rel_err > 0:
        found = panel.approxQuantile(list(columns), [prob], rel_err)
        return {c: q[0] if q else None for c, q in zip(columns, found, strict=True)}
    return {c: exact_quantiles(panel, c, [prob])[0] for c in columns}


def below(thresholds: Mapping[str, float | None]) -> list[Column]:
    return [F.col(c) < F.lit(t).cast("double") for c, t in thresholds.items()]


def bad_month_conditions(panel: DataFrame, rel_err: float = QUANTILE_ERROR) -> list[Column]:
    """The five published conditions, any of which makes a month bad."""
    return below(low_thresholds(panel, THRESHOLD_COLUMNS, LOW_QUANTILE, rel_err)) + [
        F.col("temp_min_media_mes") < COLD_BELOW,
        F.col("temp_max_media_mes") > HOT_ABOVE,
        F.col("dias_lluvia_mes") > RAINY_ABOVE,
    ]


def build_training_set(
    panel: DataFrame,
    conditions: Sequence[Column],
    key: str | Sequence[str],
    test_fraction: float = TEST_SHARE,
    label: str = "label",
) -> DataFrame:
    """Add ``label``, ``is_test`` and ``weight``; the class weight comes from the training rows.

    Give a stored panel: it is read once per step.
    """
    labelled = label_rules(panel, conditions, label)
    marked = split_stratified(labelled, label, key, test_fraction)
    ratio = class_balance(marked.filter(~F.col("is_test")), label).select("ratio").scalar()
    return marked.withColumn("weight", F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


def train_and_log(
    panel: DataFrame,
    features: Sequence[str],
    conditions: Sequence[Column],
    key: str | Sequence[str],
    run_id: str,
    path: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = FOLDS,
    parallelism: int = 4,
    **settings,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows, evaluate on the rest, save the model and log the run.

    With a ``grid`` the settings are searched by cross-validation first. The model
    goes to ``path/<run_id>/model`` and the log to ``path/runs``; returns the model
    and its one-row metrics.
    """
    rows = store(build_training_set(panel, conditions, key), "training_set")
    fit_on = rows.filter(~F.col("is_test"))
    if grid is None:
        model = train(fit_on, features, **settings)
    else:
        search = grid_search(fit_on, features, grid, folds, parallelism, key=key, **settings)
        best = max(zip(search.avgMetrics, search.getEstimatorParamMaps(), strict=True), key=lambda point: point[0])
        settings = settings | {param.name: value for param, value in best[1].items()}
        model = search.bestModel
    scored = store(score_with(model, rows.filter("is_test"), features), "scored")
    metrics = eval_confusion(scored, "label", "prediction").withColumn(
        "auc", eval_auc(scored, "label", "probability").select("auc").scalar()
    )
    save_model(model, f"{path}/{run_id}/model")
    log_run(metrics, run_id, settings, f"{path}/runs")
    return model, metrics
