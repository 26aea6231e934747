"""Text statistics, fixed quality rules and robust multivariate outliers, all in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.sources.scratch import store

SEPARATORS = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

#: The statistics as an outlier search sees them, in SQL over the columns of :func:`text_statistics`, and the least
#: standard deviation each is given: most clean texts have no symbols at all, and a variance of 0 would reject any.
TRANSFORMS = {
    "x1": ("ln(1 + n_words)", 0.25),
    "x2": ("ln((1 + word_chars) / (1.0 + n_words))", 0.08),
    "x3": ("ln(1 + 1000.0 * n_symbols / (1.0 + word_chars))", 0.5),
    "x4": ("ln(1 + n_dup_lines)", 0.5),
    "x5": ("ln(1 + 20.0 * n_repeat_words / (1.0 + n_words))", 0.5),
}
DIMENSIONS = list(TRANSFORMS)
BINS = 64
#: The 99.9 % point of chi-square with 5 degrees of freedom. Each statistic alone can lead beyond it: the tamest, repeated words, up to 23.
CUT = 20.515


def text_statistics(text: str) -> dict[str, Column]:
    """Columns of each step over the text column; later steps read those of earlier ones."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, SEPARATORS + "+"), "")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {"words": words, "lines": lines, "body": body}


def with_statistics(docs: DataFrame) -> DataFrame:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the column ``text``.

    Repeated windows are found by sorting the 64-bit hashes of all three-word windows with their places, so that equal
    windows become neighbours of known place.
    """
    split = docs.select(*[c for c in docs.columns if c != "text"], *[c.alias(n) for n, c in text_statistics("text").items()])
    counted = split.select(
        *[c for c in split.columns if c not in ("lines", "body")],
        F.size("words").cast("long").alias("n_words"),
        (F.length("body") - F.regexp_count("body", F.lit(SEPARATORS))).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    pairs = F.expr("zip_with(words, slice(words, 2, size(words)), (a, b) -> xxhash64(a, b))")
    hashed = counted.select("*", pairs.alias("pairs"))
    triples = F.expr("slice(zip_with(pairs, slice(words, 3, size(words)), (p, c) -> xxhash64(p, c)), 1, cast(greatest(n_words - 2, 0) as int))")
    hashed = hashed.select("*", triples.alias("triples")).drop("pairs", "words")
    keyed = hashed.select("*", F.expr("sort_array(transform(triples, (h, i) -> struct(h, i)))").alias("keys")).drop("triples")
    equal = F.expr("array_compact(zip_with(keys, slice(keys, 2, size(keys)), (a, b) -> if(a.h = b.h, array(a.i, b.i), null)))")
    found = keyed.select("*", F.flatten(equal).alias("at")).drop("keys")
    covered = F.expr("cast(size(array_distinct(flatten(transform(at, p -> array(p, p + 1, p + 2))))) as bigint)")
    return found.withColumn("n_repeat_words", covered).drop("at")


def cholesky_steps() -> list[tuple[str, str]]:
    """SQL steps from means ``m_i`` and covariances ``c_ij`` (j <= i) to the inverse ``r_ij`` of the lower Cholesky factor."""
    n = range(len(DIMENSIONS))
    steps = []
    for i in n:
        for j in range(i + 1):
            inner = "".join(f" - l_{i}{k} * l_{j}{k}" for k in range(j))
            steps.append((f"l_{i}{j}", f"sqrt(c_{i}{i}{inner})" if i == j else f"(c_{i}{j}{inner}) / l_{j}{j}"))
    for i in n:
        for j in range(i + 1):
            inner = " + ".join(f"l_{i}{k} * r_{k}{j}" for k in range(j, i))
            steps.append((f"r_{i}{j}", f"1 / l_{i}{i}" if i == j else f"-({inner}) / l_{i}{i}"))
    return steps


def distance_sql() -> str:
    """The squared Mahalanobis distance of a row from means and an inverse factor."""
    rows = (" + ".join(f"r_{i}{j} * ({DIMENSIONS[j]} - m_{j})" for j in range(i + 1)) for i in range(len(DIMENSIONS)))
    return " + ".join(f"power({row}, 2)" for row in rows)


def moments_sql() -> list[tuple[str, str]]:
    """Means and covariances, with the least variances added, as SQL aggregates."""
    out = [(f"m_{i}", f"avg({x})") for i, x in enumerate(DIMENSIONS)]
    for i, x in enumerate(DIMENSIONS):
        for j in range(i + 1):
            floor = f" + {TRANSFORMS[x][1] ** 2}" if i == j else ""
            out.append((f"c_{i}{j}", f"covar_pop({x}, {DIMENSIONS[j]}){floor}"))
    return out


def factor_columns() -> list[str]:
    n = range(len(DIMENSIONS))
    return [f"m_{i}" for i in n] + [f"r_{i}{j}" for i in n for j in range(i + 1)]


def _factors(rows: DataFrame) -> DataFrame:
    """Means and inverse factor of each pool."""
    out = rows.groupBy("pool").agg(*[F.expr(sql).alias(name) for name, sql in moments_sql()])
    for name, sql in cholesky_steps():
        out = out.withColumn(name, F.expr(sql))
    return out.select("pool", *factor_columns())


def _start(rows: DataFrame) -> DataFrame:
    """A first estimate from quartiles of each coordinate: the medians, and a diagonal scatter."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.expr(f"cast(floor({x} * {BINS}) as long)").alias("bin")) for i, x in enumerate(DIMENSIONS)]))
    # Written, so that the partial counts of all tasks are added up by bin before a pool's bins come together.
    counts = store(rows.select("pool", pairs.alias("p")).groupBy("pool", "p.d", "p.bin").agg(F.count("*").alias("c")), "bins")
    upto = Window.partitionBy("pool", "d").orderBy("bin")
    counts = counts.withColumns({"upto": F.sum("c").over(upto), "n": F.sum("c").over(Window.partitionBy("pool", "d"))})
    quartile = lambda q: F.min(F.expr(f"CASE WHEN upto >= {q} * n THEN (bin + 0.5) / {BINS} END"))
    spread = counts.groupBy("pool", "d").agg(quartile(0.25).alias("lo"), quartile(0.5).alias("mid"), quartile(0.75).alias("hi"))
    out = []
    for i, x in enumerate(DIMENSIONS):
        own = F.col("d") == i
        out.append(F.max(F.when(own, F.col("mid"))).alias(f"m_{i}"))
        scale = F.expr(f"1 / sqrt(power((hi - lo) / 1.349, 2) + {TRANSFORMS[x][1] ** 2})")
        out += [F.max(F.when(own, scale)).alias(f"r_{i}{j}") if i == j else F.lit(0.0).alias(f"r_{i}{j}") for j in range(i + 1)]
    return spread.groupBy("pool").agg(*out).select("pool", *factor_columns())


def _distances(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Rows with ``d2``; the estimates are read back from a written table, so a large pool can be split."""
    both = rows.join(store(factors, "factors"), "pool")
    return both.withColumn("d2", F.expr(distance_sql())).select(*rows.columns, "d2")


def _nearest(rows: DataFrame, share: float, usual: float = 0.0) -> DataFrame:
    """The rows of each pool within the least distance (in steps of 1/64 of its logarithm) that holds ``share`` of them, or within ``usual``."""
    binned = rows.withColumn("bin", F.expr(f"cast(floor(ln(1 + d2) * {BINS}) as long)"))
    counts = store(binned.groupBy("pool", "bin").agg(F.count("*").alias("c")), "bins")
    upto = Window.partitionBy("pool").orderBy("bin")
    counts = counts.withColumns({"upto": F.sum("c").over(upto), "n": F.sum("c").over(Window.partitionBy("pool"))})
    bounds = counts.where(f"upto >= {share} * n").groupBy("pool").agg(F.min("bin").alias("most"))
    return binned.join(store(bounds, "bounds"), "pool").where(f"bin <= most OR d2 <= {usual}").drop("bin", "most", "d2")


def pooled(rows: DataFrame, least: int) -> DataFrame:
    """Rows with ``pool``: language and source where they have ``least`` rows, else the language's other sources, else the rest."""
    rows = rows.withColumns({"lang": F.coalesce("lang", F.lit("")), "source": F.coalesce("source", F.lit(""))})
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    others = F.sum(F.when(F.col("n") < least, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    name = F.when(F.col("n") >= least, F.to_json(F.array("lang", "source"))).when(others >= least, F.to_json(F.array("lang"))).otherwise("[]")
    return rows.join(store(sizes.select("lang", "source", name.alias("pool")), "pools"), ["lang", "source"])


def quality_verdicts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = 200,
    share: float = 0.75,
    rounds: int = 4,
    usual: float = 12.83,
    cut: float = CUT,
) -> DataFrame:
    """Text statistics, fixed rules and outliers by the minimum covariance determinant.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance``.
    A text fails the fixed rules with fewer than 50 words or more than half of them in repeated three-word windows.

    Of those that pass, the statistics are transformed (``TRANSFORMS``), and mean and covariance of each language and source
    are estimated robustly: from the quartiles of each coordinate, ``rounds`` concentration steps keep the ``share`` of rows with the
    least Mahalanobis distance and estimate anew, which never raises the determinant; a last step uses all rows within ``usual``
    (the 97.5 % point of chi-square with 5 degrees of freedom). Texts beyond ``cut`` (normal ones with a chance of one in a thousand) are not kept.
    Sources of fewer than ``least`` passing rows are pooled by language, and those languages' rows in one rest.

    A round is one aggregation with map-side combining and one of binned distances; a source with a third of all rows is
    summed where its rows are. Null lang and source count as empty. Null and empty texts have no words and fail. Rows with
    the same id, or none, are judged like others. An empty table gives no rows.
    """
    docs = df.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    stats = with_statistics(docs).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    stats = store(stats.withColumns({x: F.expr(f"cast({sql} as double)") for x, (sql, _) in TRANSFORMS.items()}), "statistics")
    passed = stats.where("NOT base_failed")
    rows = store(pooled(passed, least).select("doc_id", "pool", *DIMENSIONS, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "pooled")
    factors = _start(rows)
    for _ in range(rounds):
        factors = _factors(_nearest(_distances(rows, factors), share))
    factors = _factors(_nearest(_distances(rows, factors), share, usual))
    judged = _distances(rows, factors).withColumnRenamed("d2", "distance")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = judged.select("doc_id", *counts, F.lit(False).alias("base_failed"), (F.col("distance") <= cut).alias("kept"), "distance")
    failed = stats.where("base_failed").select("doc_id", *counts, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.union(failed)
