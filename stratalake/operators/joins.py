"""Dimension lookups, membership joins, the wide panel and its lags.

No join here carries a broadcast hint on data of unknown size. Spark broadcasts
a side when its own size estimate is below ``autoBroadcastJoinThreshold``;
beyond it the join is a shuffle, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_dimension(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    columns: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Left join to a dimension on differently named keys, keeping only the asked columns of it.

    With ``how="inner"`` rows without a dimension entry are dropped as well. The dimension is projected before the join, so equal column names on both
    sides do not become ambiguous. ``columns`` may rename: {dimension name: output name}.
    """
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    side = dimension.select(
        F.col(dimension_key).alias("_dimension_key"), *[F.col(c).alias(out) for c, out in names.items()]
    )
    return fact.join(side, F.col(fact_key) == F.col("_dimension_key"), how).drop("_dimension_key")


def keep_members(
    fact: DataFrame, members: DataFrame, fact_key: str, member_key: str, unique: bool = True
) -> DataFrame:
    """Rows whose key occurs in the other frame, without collecting the keys.

    Adaptive execution splits a hot key on the fact side. A key repeated many
    times among the members cannot be split in a semi-join; with ``unique=False``
    repeats are thinned to at most 16 per key first. That leaves the member side
    unpartitioned by key, so the join still shuffles it and can be balanced.
    """
    side = members.select(F.col(member_key).alias("_member_key"))
    if not unique:
        slot = F.pmod(F.xxhash64(*members.columns), F.lit(16))
        side = members.select(F.col(member_key).alias("_member_key"), slot.alias("_slot")).distinct().drop("_slot")
    return fact.join(side, F.col(fact_key) == F.col("_member_key"), "left_semi")


def spread_join(fact: DataFrame, distinct: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join a fact to a frame with one row per key such that no key has to be one task.

    A frame just grouped by its key would lend the join its partitioning, and adaptive execution could not split a key that is
    hot in the fact. The constant slot makes both sides be shuffled for the join. Rows with a NULL key match nothing; they
    get slots of their own and spread out instead of meeting in one task.
    """
    slots = F.pmod(F.xxhash64(*fact.columns), F.lit(1 << 16))
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    side = distinct.withColumn("_slot", F.lit(-1).cast("long"))
    return fact.withColumn("_slot", F.when(usable, F.lit(-1)).otherwise(slots).cast("long")).join(side, [*keys, "_slot"], how).drop("_slot")


def pending(requested: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested rows whose key is not among the finished ones.

    Finished keys are made distinct first, so a batch of many rows counts once.
    """
    return spread_join(requested, done.select(*keys).distinct(), list(keys), "left_anti").select(requested.columns)


def panel_join(
    base: DataFrame,
    sides: Sequence[DataFrame | tuple[DataFrame, Mapping[str, Column]]],
    keys: Sequence[str],
    keep_fanout: bool = False,
) -> DataFrame:
    """Left-join aggregated sides to a base panel on the same keys.

    A side given as ``(frame, rollup)`` has finer grain than the keys. By default
    it is rolled up to them with the given aggregates, so the panel keeps one row
    per key; with ``keep_fanout`` it is joined as it is and repeats base rows.
    All inputs are grouped on the same keys, so the joins reuse that partitioning.
    """
    panel = base
    for side in sides:
        if isinstance(side, tuple):
            side, rollup = side
            if not keep_fanout:
                side = side.groupBy(*keys).agg(*[c.alias(name) for name, c in rollup.items()])
        panel = panel.join(side, list(keys), "left")
    return panel


def lag_features(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    n: int = 1,
    descending: bool = False,
    ties: Sequence[str] = (),
    suffix: str | None = None,
) -> DataFrame:
    """Add the value ``n`` rows earlier within each partition.

    ``order`` should be a total order together with ``ties`` (always ascending).
    Use it on a monthly panel, where a partition is one place's periods and thus
    small whatever the size of the raw data.
    """
    suffix = f"_lag{n}" if suffix is None else suffix
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    window = Window.partitionBy(*partition).orderBy(*by, *[F.col(c).asc() for c in ties])
    return df.withColumns({f"{c}{suffix}": F.lag(c, n).over(window) for c in columns})
