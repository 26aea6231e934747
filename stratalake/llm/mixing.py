"""Mixing sources, languages and topics to target shares of tokens, and sampling documents accordingly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.rows import quoted, row_struct
from stratalake.llm.wordhash import WORD
from stratalake.sources.scratch import discard, store

MARGINS = ("source", "lang", "topic")
ROUNDS = 10
TEMPER = 0.9

#: Kinds of text by what a regular expression finds, the first that fits; other text is prose.
TOPICS = {
    "listing": r"\|[^|\n]*\|[^|\n]*\|",
    "notice": r"(?i)licen[cs]e|copyright|all rights reserved",
    "contact": r"[A-Za-z0-9]@[A-Za-z0-9]|https?://",
}


def topic_of(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS.items()):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return F.when(text.isNull(), "prose").otherwise(out)


def uniform(id_column: Column) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def described(df: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, carry: Sequence[str] | None) -> DataFrame:
    """The rows as ``row`` with their tokens, margins and random number; a null margin counts as empty."""
    text = quoted(text_col)
    return df.select(
        row_struct(df, carry),
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
        F.coalesce(quoted(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(quoted(lang_col).cast("string"), F.lit("")).alias("lang"),
        topic_of(text).alias("topic"),
        uniform(quoted(id_col)).alias("u"),
    )


def target_shares(cells: DataFrame, margin: str, given: dict[str, float] | None, temper: float) -> DataFrame:
    """``margin, share_<margin>``: the given shares, or the present ones to the power ``temper``, scaled to 1."""
    if given is not None:
        total = sum(given.values())
        return cells.sparkSession.createDataFrame([(k, v / total) for k, v in given.items()], f"{margin} string, share_{margin} double")
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    total = sums.agg(F.sum(F.pow("t", F.lit(temper)))).first()[0] or 1.0
    return sums.select(margin, (F.pow("t", F.lit(temper)) / total).alias(f"share_{margin}"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], total: float, rounds: int) -> DataFrame:
    """Cells with ``f``, by which their tokens have to be weighed so that all margins meet their targets; a value without target gets none.

    Each step scales the cells of each value of one margin to that value's target; a round does so for every margin.
    Sums are aggregated with map-side combining and joined back, so a margin value with most of the cells isn't a task of its own. The joins
    are merges: a broadcast for each of so many small steps would fill the driver's memory.
    """
    margins = list(targets)
    start = cells.withColumn("f", F.lit(1.0))
    for margin, shares in targets.items():
        start = start.join(shares.hint("merge"), margin, "left").fillna(0.0, [f"share_{margin}"])
    cells = store(start, "cells")
    for _ in range(rounds):
        before = cells
        for margin in margins:
            sums = cells.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("f")).alias("s"))
            scale = F.when(F.col("s") > 0, F.col(f"share_{margin}") * total / F.col("s")).otherwise(1.0)
            cells = cells.join(sums.hint("merge"), margin).withColumn("f", F.col("f") * scale).drop("s")
        cells = store(cells, "cells")
        discard(before)
    return cells


def calibrated(fitted: DataFrame, size: float) -> float:
    """The ``c`` for which the chances ``min(1, c * f)`` of all cells give ``size`` tokens; infinite if there are fewer.

    Cells at chance 1 are taken out and the rest scaled anew, until no further cell reaches 1. Each step can only raise ``c``.
    """
    c, full = 0.0, -1
    while True:
        whole = F.col("f") * c >= 1
        row = fitted.where("tokens > 0 AND f > 0").agg(
            F.count_if(whole).alias("n"), F.sum(F.when(whole, F.col("tokens"))).alias("taken"), F.sum(F.when(~whole, F.col("tokens") * F.col("f"))).alias("rest")
        ).first()
        if row["n"] == full:
            return c
        if not row["rest"]:
            return float("inf")
        c, full = (size - (row["taken"] or 0)) / row["rest"], row["n"]


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    targets: dict[str, dict[str, float]] | None = None,
    temper: float = TEMPER,
    rounds: int = ROUNDS,
    size: float | None = None,
    share: float | None = None,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``row, n_tokens, source, lang, topic, weight, probability, selected, shortfall``: a sample that has the target mix of tokens.

    ``targets`` gives shares of tokens for values of ``source``, ``lang`` or ``topic`` (a value left out gets none); margins
    not given are tempered: the present shares to the power ``temper``. Iterative proportional fitting over the cells
    (source, language, topic) finds a weight for each that meets all margins at once. The sample is to have ``size`` expected tokens, or ``share`` of those there are:
    a document's probability is ``min(1, c * weight)`` with ``c`` such that all cells together give that many, and it is chosen if a number made of its id's MD5 is
    below. So a cell that cannot give its part is taken whole, ``shortfall`` being the share of its tokens in the mix that it lacks, and does not thin the
    others. With neither, the probability is the weight over the largest one: the expected sample has exactly the fitted mix, and the cell of largest weight sets how
    much is chosen.

    Tokens are words. A topic is the kind of text by :data:`TOPICS`. Documents are read once: what is found of each is written with ``row``, the input columns named by ``carry`` (all by
    default; leave out the text where only the verdicts are wanted), and then joined with its cell. Only the cells (one number each) are fitted. Null margins count as an
    empty value, null texts have no tokens and are chosen by their cell's probability. Repeated rows and ids are chosen alike. Without any tokens
    every row is chosen. An empty table gives no rows.
    """
    rows = store(described(df, id_col, text_col, source_col, lang_col, carry), "described")
    cells = store(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "tokens")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    shares = {m: store(target_shares(cells, m, (targets or {}).get(m), temper), "shares") for m in MARGINS}
    fitted = rake(cells, shares, total, rounds) if total else store(cells.withColumn("f", F.lit(1.0)), "cells")
    discard(cells, *shares.values())
    if share is not None:
        size = share * total
    if size is None:
        scale = 1.0 / (fitted.where("tokens > 0").agg(F.max("f")).first()[0] or 1.0)
    else:
        scale = calibrated(fitted, size) if total else 1.0
    asked = F.when(F.col("f") > 0, F.col("f") * scale).otherwise(0.0)
    shortfall = F.greatest(F.lit(0.0), 1 - 1 / F.greatest(asked, F.lit(1.0)))
    cell = fitted.select(*MARGINS, F.col("f").alias("weight"), F.least(F.lit(1.0), asked).alias("probability"), shortfall.alias("shortfall"))
    chosen = (F.col("u") < F.col("probability")).alias("selected")
    return rows.join(cell, list(MARGINS)).select("row", "n_tokens", *MARGINS, "weight", "probability", chosen, "shortfall")
