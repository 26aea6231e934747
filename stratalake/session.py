"""Session helper for applications and tests; operators never create one."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans in this package count on. Master, memory, executor counts
# and spark.checkpoint.dir belong to the deployment and are not set here.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session(app_name: str = "stratalake", **settings: str) -> SparkSession:
    """Return the running session, or start one with the plan settings above.

    Extra settings use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**PLAN_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
