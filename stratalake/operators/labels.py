"""Binary labels, stratified splits, class balance and weights."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.scratch import store


def label_rules(df: DataFrame, bad_when: Sequence[Column], out: str = "label") -> DataFrame:
    """0 where any condition holds, else 1. A condition that is NULL does not hold."""
    return df.withColumn(out, F.when(reduce(or_, bad_when), 0).otherwise(1))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives and their ratio (NULL without positives)."""
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_neg"), F.count_if(F.col(label) == 1).alias("n_pos")
    ).withColumn("ratio", F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos").cast("double")))


def class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight positives by negatives/positives and negatives by 1.

    The ratio is a one-row scalar subquery, so the rows themselves do not move.
    """
    ratio = class_balance(df, label).select("ratio").scalar()
    return df.withColumn(out, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))


_SLICE = 4  # hex digits of a digest that make a slice: 65,536 slices for each class, and as many parts of a slice


def _digests(df: DataFrame, key: str | Sequence[str] | None) -> Column:
    """The digest that orders the rows: of their key, or of the whole row where a key column is NULL or no key is given."""
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    if not keys:
        return row
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(known, F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))).otherwise(row)


def _upto(counts: DataFrame, within: Sequence[str], order: str, n: str = "n") -> DataFrame:
    """Add the running total of ``n``; the frame holds at most 65,536 rows within each group."""
    return counts.withColumn("upto", F.sum(n).over(Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def _cuts(rows: DataFrame, label: str, needs: Callable[[Column], Column]) -> DataFrame:
    """``label, _cuts``: for each class the digests up to which as many of its rows go as the array ``needs(class size)`` says, ascending.

    A need of 0 has no cut. Digests spread evenly, so counting rows by slice finds the slices that hold the cuts; the rows of those slices
    are counted by digest and written, and counting the parts of a slice leaves one row in 2**32 to be ordered. All of it is
    aggregations: two scans of the rows, and windows over 65,536 counts at most.
    """
    slices = rows.groupBy(label, F.substring("_digest", 1, _SLICE).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    slices = _upto(slices, [label], "slice").withColumn("total", F.sum("n").over(Window.partitionBy(label)))
    needed = slices.select("*", F.posexplode(needs(F.col("total"))).alias("cut", "need"))
    holding = needed.filter("upto >= need AND upto - n < need AND need > 0").select(label, "slice", "cut", (F.expr("need - upto + n")).alias("left"))
    inside = rows.withColumn("slice", F.substring("_digest", 1, _SLICE)).join(holding, [label, "slice"])
    inside = inside.groupBy(label, "cut", "left", F.substring("_digest", 1, 2 * _SLICE).alias("part"), "_digest").agg(F.count(F.lit(1)).alias("n"))
    inside = store(inside, "inside")
    parts = _upto(inside.groupBy(label, "cut", "left", "part").agg(F.sum("n").alias("n")), [label, "cut"], "part")
    parts = parts.filter("upto >= left AND upto - n < left").select(label, "cut", "part", F.expr("left - upto + n").alias("few"))
    last = _upto(inside.join(parts, [label, "cut", "part"]), [label, "cut"], "_digest").filter("upto >= few")
    found = last.groupBy(label, "cut").agg(F.min("_digest").alias("digest"))
    return found.groupBy(label).agg(F.sort_array(F.collect_list("digest")).alias("_cuts"))  # as many as needs


def split_stratified(
    df: DataFrame, label: str, key: str | Sequence[str], test_fraction: float = 0.2, out: str = "is_test"
) -> DataFrame:
    """Mark an exact share of every class as test rows, repeatably.

    Rows are taken in the order of the MD5 digest of their key, so the choice
    depends on the key alone, and rows sharing a key stay on one side. A key with a NULL in it identifies nothing: such a row is
    taken by the digest of all its columns. Rows without label are never test rows. The cuts are found in two counting passes and joined
    back as one row per class.
    """
    marked = df.withColumn("_digest", _digests(df, key))
    # + 0.5 and floor: the same half-up rounding on every platform
    needs = lambda total: F.array(F.floor(total * F.lit(test_fraction) + F.lit(0.5 + 1e-9)))
    cuts = _cuts(marked.filter(F.col(label).isNotNull()).select(label, "_digest"), label, needs)
    both = marked.join(store(cuts, "cuts"), [label], "left")
    return both.withColumn(out, F.coalesce(F.col("_digest") <= F.get("_cuts", F.lit(0)), F.lit(False))).select(*[c for c in df.columns if c != out], out)


def stratified_folds(df: DataFrame, label: str, key: str | Sequence[str] | None = None, folds: int = 10, out: str = "fold") -> DataFrame:
    """Deal the rows of every class into ``folds`` folds, repeatably: 0 to ``folds`` - 1, of equal size in each class but for one row.

    The row at place r (from 0) of n in the order of its key's MD5 digest goes to fold ``r * folds div n``. Rows sharing a key, or being equal where no key
    is given, share a fold, which may then hold more; a key with a NULL in it identifies nothing, and such a row goes by its whole content. Rows
    without label get no fold. All cuts of all classes come out of the same two counting passes as the one of :func:`split_stratified`.
    """
    if folds < 2:
        raise ValueError("at least two folds")
    marked = df.withColumn("_digest", _digests(df, key))
    needs = lambda total: F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda j: F.ceil(j * total / F.lit(folds) - F.lit(1e-9)))
    cuts = _cuts(marked.filter(F.col(label).isNotNull()).select(label, "_digest"), label, needs)
    both = marked.join(store(cuts, "cuts"), [label], "left")
    fold = F.size(F.filter("_cuts", lambda cut: F.col("_digest") > cut))
    return both.withColumn(out, F.when(F.col(label).isNotNull(), fold)).select(*[c for c in df.columns if c != out], out)


def split_sampled(df: DataFrame, label: str, classes: Sequence, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """The test rows of an approximate stratified split, in one pass."""
    return df.sampleBy(label, {c: test_fraction for c in classes}, seed)
