"""Batch scoring: feature lookup, prediction, seasonal and climate adjustment, verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.chance import clip, percent_text, sigmoid
from stratalake.operators.aggregate import mean_by
from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import store

# ---- fixed values ---------------------------------------------------------

# (months, bias) per place; months not listed take the place's default.
SEASON_BIAS = {
    "Barcelona": ([((6, 7, 8), 0.30), ((4, 5, 9, 10), 0.45), ((12, 1, 2), 0.10)], 0.25),
    "Illes Balears": ([((6, 7, 8), 0.30), ((4, 5, 9, 10), 0.45), ((12, 1, 2), 0.10)], 0.25),
    "Valencia": ([((6, 7, 8), -0.40), ((4, 5, 9, 10), 0.40), ((11, 12, 1, 2), 0.10)], 0.25),
    "Sevilla": ([((6, 7, 8), -0.85), ((5, 9), -0.25), ((4, 10), 0.25), ((11, 12, 1, 2), 0.05)], 0.15),
    "Madrid": ([((12, 1, 2), -0.15), ((3, 4, 5), 0.25), ((6, 7, 8), -0.10), ((9, 10, 11), 0.20)], 0.0),
}
PLACE_THRESHOLDS = {"Barcelona": 0.40, "Valencia": 0.53, "Madrid": 0.34, "Sevilla": 0.40, "Illes Balears": 0.45}
DEFAULT_THRESHOLD = 0.5
MODEL_SHARE, SEASON_SHARE, SEASON_SLOPE = 0.55, 0.45, 4.0
SUMMER, SHOULDER = (6, 7, 8), (4, 5, 9, 10)
SUMMER_CUT, SHOULDER_CUT, OTHER_CUT = 0.50, 0.42, 0.46
RAIN_DAYS_LIMIT, COLD_LIMIT, HOT_LIMIT = 8, 10, 30
RAIN_PENALTY, COLD_PENALTY, HOT_PENALTY = 0.1, 0.05, 0.1
MISSING_RAIN_DAYS, MISSING_TEMPERATURE = 0.0, 20.0
GOOD_TEXT = "✅ Es un buen momento para viajar a "
BAD_TEXT = "⚠️ No es un buen momento para viajar a "
TEXT_TAIL = " de probabilidad favorable)"


def season_bias_rows(bias: Mapping = SEASON_BIAS) -> list[tuple[str, int, float]]:
    """(place, month, bias) for every place and month of the table."""
    rows = []
    for place, (seasons, default) in bias.items():
        by_month = {m: b for months, b in seasons for m in months}
        rows += [(place, m, by_month.get(m, default)) for m in range(1, 13)]
    return rows


# ---- feature lookup -------------------------------------------------------

def _look_up(requests: DataFrame, lookup: DataFrame, place: str, date: str) -> DataFrame:
    """Left-join requests to a table keyed by (place, month).

    The table has at most twelve rows per place. It is stored first, so Spark knows
    its size and broadcasts it when small; requests then do not move at all.
    """
    dated = requests.withColumns({"year": F.year(date), "month": F.month(date)})
    known = store(lookup, "lookup").withColumn("found", F.lit(True))
    return dated.join(known, [place, "month"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def score_lookup(
    requests: DataFrame, features: DataFrame, place: str, date: str, columns: Sequence[str], feature_month: str = "month"
) -> DataFrame:
    """Add ``year``, ``month`` and the place's mean features for that month; NULL where there are none."""
    monthly = mean_by(features.withColumnRenamed(feature_month, "month"), [place, "month"], columns)
    return _look_up(requests, monthly, place, date)


def score_month_fallback(
    requests: DataFrame, features: DataFrame, place: str, date: str, columns: Sequence[str], feature_month: str = "month"
) -> DataFrame:
    """``score_lookup`` with a fallback for months the place has no features for.

    The fallback is the place's median feature month. Where that median is not
    itself a month with features, the request stays without features. All twelve
    months of a place are resolved up front, so requests are joined once.
    """
    rows = features.withColumnRenamed(feature_month, "month")
    # the median may fall between two months, hence the comparison as doubles
    monthly = mean_by(rows, [place, "month"], columns).withColumnRenamed("month", "used_month")
    monthly = monthly.withColumn("used_month", F.col("used_month").cast("double"))
    month = F.col("month")
    # The set and the median buffer hold at most twelve values.
    calendar = (
        rows.groupBy(place)
        .agg(F.collect_set("month").alias("_present"), F.median("month").alias("_median"))
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .withColumn(
            "used_month",
            F.when(F.array_contains("_present", month), month.cast("double")).otherwise(F.col("_median")),
        )
        .select(place, "month", "used_month")
    )
    resolved = calendar.join(monthly, [place, "used_month"])
    return _look_up(requests, resolved.withColumn("used_month", F.col("used_month").cast("int")), place, date)


# ---- probability ----------------------------------------------------------

def rescale_scores(df: DataFrame, raw: str, out: str = "probability") -> DataFrame:
    """Map raw scores to 0.05..0.95 over their own range, read as a one-row scalar subquery."""
    bounds = df.agg(F.struct(F.min(raw).alias("lo"), F.max(raw).alias("hi"))).scalar()
    low, high = bounds.getField("lo"), bounds.getField("hi")
    return df.withColumn(out, F.lit(0.05) + F.lit(0.9) * (F.col(raw) - low) / (high - low + F.lit(1e-6)))


def predict_batch(df: DataFrame, probability: str, threshold: float = 0.5, out: str = "prediction") -> DataFrame:
    """1 above the threshold, else 0; NULL where there is no probability."""
    p = F.col(probability)
    return df.withColumn(out, F.when(p.isNotNull(), (p > threshold).cast("int")))


def seasonal_adjust(
    df: DataFrame, probability: str, place: str, month: str, bias: DataFrame | None = None, out: str = "adjusted"
) -> DataFrame:
    """Blend the model probability with a seasonal one, and add ``season_prediction`` by monthly threshold.

    ``bias`` holds (place, month, bias); unknown places and months count as 0.
    """
    if bias is None:
        bias = literal_dim(df.sparkSession, season_bias_rows(), "place string, month int, bias double")
    table = bias.select(
        F.col("place").alias("_place"), F.col("month").alias("_month"), F.col("bias").alias("_bias")
    )
    joined = df.join(table, (F.col(place) == F.col("_place")) & (F.col(month) == F.col("_month")), "left")
    p = F.col(probability)
    seasonal = sigmoid((p - 0.5) * SEASON_SLOPE + F.coalesce("_bias", F.lit(0.0)))
    cut = (
        F.when(F.col(month).isin(list(SUMMER)), SUMMER_CUT)
        .when(F.col(month).isin(list(SHOULDER)), SHOULDER_CUT)
        .otherwise(OTHER_CUT)
    )
    return (
        joined.withColumn(out, MODEL_SHARE * p + SEASON_SHARE * seasonal)
        .withColumn("season_prediction", F.when(F.col(out).isNotNull(), (F.col(out) > cut).cast("int")))
        .drop("_place", "_month", "_bias")
    )


def climate_penalty(df: DataFrame, probability: str, rain_days: str, mean_temp: str, out: str = "adjusted") -> DataFrame:
    """Lower the probability for many rain days, cold and heat, then clip to [0, 1].

    A column the frame lacks, like a missing value, brings no penalty.
    """

    def reading(name: str, default: float):
        if name not in df.columns:
            return F.lit(default)
        return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(default)), F.lit(default))

    rain, temp = reading(rain_days, MISSING_RAIN_DAYS), reading(mean_temp, MISSING_TEMPERATURE)
    wet = F.when(rain > RAIN_DAYS_LIMIT, RAIN_PENALTY * (rain - RAIN_DAYS_LIMIT) / 10).otherwise(0.0)
    extreme = (
        F.when(temp < COLD_LIMIT, COLD_PENALTY * (COLD_LIMIT - temp) / 10)
        .when(temp > HOT_LIMIT, HOT_PENALTY * (temp - HOT_LIMIT) / 10)
        .otherwise(0.0)
    )
    return df.withColumn(out, clip(F.col(probability) - wet - extreme))


def verdict(
    df: DataFrame,
    probability: str,
    place: str,
    thresholds: DataFrame | None = None,
    default: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Add ``threshold``, ``recommended`` (probability at or above it) and ``verdict`` text."""
    if thresholds is None:
        thresholds = literal_dim(df.sparkSession, list(PLACE_THRESHOLDS.items()), "place string, threshold double")
    table = thresholds.select(F.col("place").alias("_place"), F.col("threshold").alias("_threshold"))
    p = F.col(probability)
    marked = (
        df.join(table, F.col(place) == F.col("_place"), "left")
        .withColumn("threshold", F.coalesce("_threshold", F.lit(default)))
        .drop("_place", "_threshold")
        .withColumn("recommended", F.when(p.isNotNull(), (p >= F.col("threshold")).cast("int")))
    )
    opening = F.when(F.col("recommended") == 1, GOOD_TEXT).when(F.col("recommended") == 0, BAD_TEXT)
    return marked.withColumn(
        "verdict",
        F.concat(opening, F.col(place).cast("string"), F.lit(" ("), percent_text(p), F.lit(TEXT_TAIL)),
    )
