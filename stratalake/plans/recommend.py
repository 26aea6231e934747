"""Batch recommendation: lookup, probability, seasonal and climate adjustment, verdict."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.learn import score_with
from stratalake.operators.score import (
    climate_penalty,
    predict_batch,
    score_month_fallback,
    seasonal_adjust,
    verdict,
)


def model_probability(model, columns: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """A fitted model as the ``probability`` argument of ``recommend_batch``."""
    return lambda df: score_with(model, df, columns).drop("prediction")


def recommend_batch(
    requests: DataFrame,
    features: DataFrame,
    place: str,
    date: str,
    columns: Sequence[str],
    probability: Column | Callable[[DataFrame], DataFrame],
    rain_days: str = "dias_lluvia_mes_lag1",
    mean_temp: str = "temp_media_mes",
    feature_month: str = "month",
    bias: DataFrame | None = None,
    thresholds: DataFrame | None = None,
) -> DataFrame:
    """Score any number of (place, date) requests in one plan.

    ``probability`` is an expression over the looked-up features, or a function
    that adds a ``probability`` column, such as a fitted model. Requests without
    features keep NULL results.
    """
    enriched = score_month_fallback(requests, features, place, date, columns, feature_month)
    if callable(probability):
        scored = probability(enriched)
    else:
        scored = enriched.withColumn("probability", F.when(F.col("found"), probability))
    return (
        scored.transform(predict_batch, "probability")
        .transform(seasonal_adjust, "probability", place, "month", bias, "adjusted")
        .transform(climate_penalty, "adjusted", rain_days, mean_temp, "adjusted")
        .transform(verdict, "adjusted", place, thresholds)
    )
