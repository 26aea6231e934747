"""Exact ordered statistics that never sort everything in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, inf
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.literal import literal_dim
from stratalake.sources.scratch import store

#: Distinct values that one task sums; the number of tasks follows from the number of values.
VALUES_PER_RANGE = 250_000


def _sum_before(window):
    """Expression builder: total of a column over the earlier rows of the window, 0 for the first."""
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    return lambda w: F.coalesce(F.sum(w).over(frame), F.lit(0))


def running_totals(
    counts: DataFrame, value: str, weights: Sequence[str], ranges: int | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<weight>_before``: the total weight of all strictly smaller values, within each ``by`` group if given.

    ``counts`` holds one row per distinct value (and group) and should be a stored table, as it is counted first. The rows are
    dealt out by ranges of the value, one for every ``VALUES_PER_RANGE`` rows, and written with their range, so every later pass sees the
    same ranges and the totals are exact whatever the ranges are. Each range is summed by itself; the ranges' own totals are added before.
    """
    ranges = ranges or max(1, ceil(counts.count() / VALUES_PER_RANGE))
    dealt = counts.repartitionByRange(ranges, *by, value).withColumn("_range", F.spark_partition_id())
    dealt = store(dealt, "ranges")
    sums = dealt.groupBy(*by, "_range").agg(*[F.sum(w).alias(w) for w in weights])
    earlier = _sum_before(Window.partitionBy(*by).orderBy("_range"))  # one row per range and group
    offsets = sums.select(*by, "_range", *[earlier(w).alias(f"_{w}_offset") for w in weights])
    local = _sum_before(Window.partitionBy(*by, "_range").orderBy(value))
    summed = dealt.withColumns({f"_{w}_local": local(w) for w in weights})
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "_range")])
    joined = summed.alias("s").join(offsets.alias("o"), same)
    totals = [(F.col(f"_{w}_local") + F.col(f"_{w}_offset")).alias(f"{w}_before") for w in weights]
    return joined.select(*[F.col(f"s.{c}") for c in counts.columns], *totals)


def _per_column(values: dict[str, float | int | None]) -> Column:
    """The number that belongs to the row's column name ``c``."""
    out = F.lit(None).cast("double")
    for name, value in values.items():
        out = F.when(F.col("c") == name, F.lit(None if value is None else float(value)).cast("double")).otherwise(out)
    return out


def _values_at(values: DataFrame, ranks: dict[str, list[int]]) -> dict[str, list[float | None]]:
    """The values of ``v`` at the given ranks of each column; NULL beyond the last rank."""
    counts = store(values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")), "value_counts")
    totals = running_totals(counts, "v", ["n"], by=["c"])
    upto = F.col("n_before") + F.col("n")
    width = max(map(len, ranks.values()), default=0)
    at = [_per_column({c: ks[i] for c, ks in ranks.items() if i < len(ks)}) for i in range(width)]
    found = totals.groupBy("c").agg(*[F.min(F.when(upto >= k, F.col("v"))).alias(f"q{i}") for i, k in enumerate(at)])
    rows = {r["c"]: list(r)[1:] for r in found.collect()}
    return {c: rows.get(c, [None] * width)[: len(ks)] for c, ks in ranks.items()}


def exact_quantiles_of(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], slack: float = 0.002
) -> dict[str, list[float | None]]:
    """Discrete quantiles of several columns: the value at rank ``ceil(p * n)``, ignoring NULL and NaN.

    All columns go through three passes together: one counts and sketches a bracket around each
    quantile, one counts what lies below the brackets, and one counts the values inside them one by one. Only those
    are shuffled. A bracket that misses its rank would show, and then that column is counted whole.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns]))
    values = df.select(each.alias("_each")).select("_each.*").filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = [p + side * 2 * slack for p in probs for side in (-1, 1)]
    sketch = F.percentile_approx("v", [min(max(e, 0.0), 1.0) for e in ends], ceil(1 / slack))
    rows = values.groupBy("c").agg(F.count(F.lit(1)).alias("n"), sketch.alias("found")).collect()  # one row per column
    if not rows:
        return {c: [None for _ in probs] for c in columns}
    # round() drops the float noise of p * n before the ceiling is taken
    ranks = {r["c"]: [max(ceil(round(p * r["n"], 6)), 1) for p in probs] for r in rows}
    found = {r["c"]: [-inf if e <= 0 else inf if e >= 1 else x for e, x in zip(ends, r["found"], strict=True)] for r in rows}
    lows = [_per_column({c: f[2 * i] for c, f in found.items()}) for i in range(len(probs))]
    highs = [_per_column({c: f[2 * i + 1] for c, f in found.items()}) for i in range(len(probs))]
    inside = reduce(or_, [F.col("v").between(low, high) for low, high in zip(lows, highs, strict=True)])
    # values outside all brackets only count towards the ranks
    below = [F.count_if((F.col("v") < low) & ~inside).alias(f"b{i}") for i, low in enumerate(lows)]
    skipped = {r["c"]: list(r)[1:] for r in values.groupBy("c").agg(*below).collect()}
    shifted = {c: [k - s for k, s in zip(ks, skipped[c], strict=True)] for c, ks in ranks.items()}
    quantiles = _values_at(values.filter(inside), shifted)
    missed = [
        c
        for c, qs in quantiles.items()
        if not all(k >= 1 and q is not None and lo <= q <= hi for k, q, lo, hi in zip(shifted[c], qs, found[c][::2], found[c][1::2], strict=True))
    ]
    if missed:
        quantiles |= _values_at(values.filter(F.col("c").isin(missed)), {c: ranks[c] for c in missed})
    return {c: quantiles.get(c, [None for _ in probs]) for c in columns}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], slack: float = 0.002) -> list[float | None]:
    """Discrete quantiles of one column, see :func:`exact_quantiles_of`."""
    return exact_quantiles_of(df, [column], probs, slack)[column]


def quantile_thresholds(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], rel_err: float = 0.0
) -> DataFrame:
    """Rows (column_name, prob, value), NULL and NaN ignored.

    With ``rel_err`` > 0 all columns come from one sketching pass; 0 asks for the
    exact discrete quantiles.
    """
    spark = df.sparkSession
    if rel_err > 0:
        accuracy = int(round(1 / rel_err))
        numbers = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
        sketch = df.agg(
            *[F.percentile_approx(v, [float(p) for p in probs], accuracy).alias(c) for c, v in numbers.items()]
        )
        entries = [
            F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"), F.get(c, F.lit(i)).alias("value"))
            for c in columns
            for i, p in enumerate(probs)
        ]
        return sketch.select(F.inline(F.array(*entries)))
    found = exact_quantiles_of(df, columns, probs)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c], strict=True)]
    return literal_dim(spark, rows, "column_name string, prob double, value double")
