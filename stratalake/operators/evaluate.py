"""Classification metrics as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.ordered import running_totals
from stratalake.sources.scratch import store


def eval_confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tp, fp, fn, tn, accuracy, precision, recall and F1; a zero denominator gives 0."""
    y, p = F.col(label), F.col(prediction)
    cells = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )

    def share(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": share(tp + tn, tp + fp + fn + tn),
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def eval_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: positives, negatives and the exact area under the ROC curve.

    Rows collapse to one per distinct score first, so a score shared by most rows
    is one row. Each positive then counts the negatives scored below it and half
    of those scored equal.
    """
    s = F.col(score).cast("double")
    counts = store(
        df.filter(s.isNotNull() & ~F.isnan(s))
        .groupBy(s.alias("s"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")),
        "score_counts",
    )
    won = F.col("pos") * (F.col("neg_before").cast("double") + F.col("neg") / 2)
    return (
        running_totals(counts, "s", ["neg"])
        .agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum(won).alias("_won"))
        .select(
            "n_pos",
            "n_neg",
            F.try_divide("_won", F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"),
        )
    )
