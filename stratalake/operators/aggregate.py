"""Monthly feature blocks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.clock import decimal_to_time, time_to_decimal


def aggregate_block(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Grouped measures, then columns computed from them.

    The measures are built-in aggregates, so Spark combines them map-side and a
    hot key crosses the shuffle as one row per task.
    """
    block = df.groupBy(*keys).agg(*[c.alias(name) for name, c in measures.items()])
    return block.withColumns(dict(derived)) if derived else block


def avg_when(condition: Column, value: Column) -> Column:
    """Average over the rows that satisfy the condition; NULL when none does."""
    return F.avg(F.when(condition, value))


def smoothed_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``a / (b + 1)``, defined for b = 0."""
    a = F.col(numerator) if isinstance(numerator, str) else numerator
    b = F.col(denominator) if isinstance(denominator, str) else denominator
    return a / (b + 1)


def occupancy_block(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    averages: Mapping[str, str],
    occupancy: str,
    score: str = "availability_score",
) -> DataFrame:
    """Sums and averages per key, and a score of 100 minus the averaged occupancy.

    ``sums`` and ``averages`` map output names to input columns; ``occupancy`` is
    one of the averaged output names.
    """
    measures = {o: F.sum(c) for o, c in sums.items()} | {o: F.avg(c) for o, c in averages.items()}
    return aggregate_block(df, keys, measures, {score: 100 - F.col(occupancy)})


def leisure_block(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    averages: Mapping[str, str],
    ratios: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Sums and averages per key, and smoothed ratios between output columns."""
    measures = {o: F.sum(c) for o, c in sums.items()} | {o: F.avg(c) for o, c in averages.items()}
    return aggregate_block(df, keys, measures, {o: smoothed_ratio(a, b) for o, (a, b) in ratios.items()})


def bucket_share_block(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    value: str,
    buckets: Mapping[str, Sequence[str]],
    weights: Mapping[str, float],
    entity: str,
    n_entities: str = "n_entities",
    index: str = "quality_index",
    guard: float = 1e-6,
) -> DataFrame:
    """Average value per label bucket, distinct entities, and a weighted index.

    A bucket without rows is NULL, and then so is the index.
    """
    measures = {out: avg_when(F.col(label).isin(list(names)), F.col(value)) for out, names in buckets.items()}
    measures[n_entities] = F.countDistinct(entity)
    weighted = sum((F.col(out) * F.lit(float(weights[out])) for out in buckets), F.lit(0.0))
    total = sum((F.col(out) for out in buckets), F.lit(0.0))
    return aggregate_block(df, keys, measures, {index: weighted / (total + F.lit(guard))})


def mixed_block(
    df: DataFrame, keys: Sequence[str], averages: Mapping[str, str], sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Averages and sums per key; which column gets which is the caller's choice."""
    measures = {o: F.avg(c) for o, c in averages.items()} | {o: F.sum(c) for o, c in (sums or {}).items()}
    return aggregate_block(df, keys, measures)


# A day counts as rainy, warm or frosty beyond these.
RAIN_ABOVE, WARM_ABOVE, FROST_BELOW = 0, 30, 0


def climate_block(
    df: DataFrame,
    keys: Sequence[str],
    mean: str,
    rain: str,
    low: str,
    high: str,
    low_time: str,
    high_time: str,
    warm_above: float = WARM_ABOVE,
    frost_below: float = FROST_BELOW,
) -> DataFrame:
    """Monthly climate from daily readings: means, extremes, ranges, day counts and mean clock times."""
    lo, hi = F.col(low), F.col(high)
    measures = {
        "temp_media_mes": F.avg(mean),
        "precipitacion_total_mes": F.sum(rain),
        "dias_lluvia_mes": F.count_if(F.col(rain) > RAIN_ABOVE),
        "temp_min_media_mes": F.avg(lo),
        "temp_min_abs_mes": F.min(lo),
        "temp_max_media_mes": F.avg(hi),
        "temp_max_abs_mes": F.max(hi),
        "rango_termico_medio": F.avg(hi) - F.avg(lo),
        "rango_termico_extremo": F.max(hi) - F.min(lo),
        "dias_calidos": F.count_if(hi > warm_above),
        "dias_helada": F.count_if(lo < frost_below),
        "hora_temp_min_media": decimal_to_time(F.avg(time_to_decimal(F.col(low_time)))),
        "hora_temp_max_media": decimal_to_time(F.avg(time_to_decimal(F.col(high_time)))),
    }
    return aggregate_block(df, keys, measures)


def mean_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mean of every listed column per key."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])
