"""Judging URLs by host rules, and by character models of accepted and rejected ones where no rule fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.scratch import discard, store

#: The share of its length's strings below which a string is left out: none is. The plain version reads it.
SHARE = 0.0
ORDER = 5
STRENGTH = 2.0
BIN = 1 / 64
#: Marks the start and the end of an address.
EDGE = "\u0002"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as the text after the first ``://`` gives them; empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, "(?s)^.*?://", ""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(F.regexp_replace(rest, "(?s)^[^/?#]*", ""), "(?s)^[^?#]*", 0)
    return F.translate(host, upper, lower), path


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict. A rule is a host and the start of a path; it fits subdomains too."""
    rule = verdict = F.lit(None).cast("string")
    for text, then in sorted(rules, key=lambda r: len(r[0])):
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, then).otherwise(verdict)
    return rule, verdict


def address() -> Column:
    """What the models read: the host from the top domain down, then the path, digits as one sign."""
    labels = F.array_join(F.reverse(F.split("host", r"\.")), ".")
    return F.regexp_replace(F.concat(F.lit(EDGE), labels, F.col("path"), F.lit(EDGE)), "[0-9]", "0")


def distinct_addresses(rows: DataFrame) -> DataFrame:
    """``address, allow, block, id``: each address once, with how often rules accept and reject it."""
    weights = rows.groupBy("address").agg(*[F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")])
    return weights.withColumn("id", F.monotonically_increasing_id())


def gram_counts(addresses: DataFrame, order: int) -> DataFrame:
    """How often each string of up to ``order + 1`` characters occurs in accepted and in rejected addresses."""
    grams = F.expr(f"flatten(transform(sequence(1, {order + 1}), k -> transform(sequence(1, greatest(length(address) - k + 1, 1)), i -> substring(address, i, k))))")
    each = addresses.where("allow + block > 0").select(F.explode(grams).alias("gram"), "allow", "block")
    return each.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))


def address_keys(addresses: DataFrame, order: int) -> DataFrame:
    """``id, key`` for every character of an address but the first: its context of up to ``order`` characters and itself."""
    keys = F.expr(f"transform(sequence(2, length(address)), i -> substring(address, greatest(1, i - {order}), least(i, {order + 1})))")
    return addresses.select("id", F.explode(keys).alias("key"))


def log_ratios(keys: DataFrame, counts: DataFrame, order: int, strength: float = STRENGTH) -> DataFrame:
    """``key, ratio``: what :meth:`CharacterModels.ratio` gives for every key, by joins with the written counts.

    Strings of one length are smoothed towards the results for the strings without their first character, length by length.
    """
    ends = F.expr("transform(sequence(1, length(key)), k -> right(key, k))")
    strings = store(keys.select("key").distinct().select(F.explode(ends).alias("key")).distinct(), "strings")
    alphabet = 1 + counts.where("length(gram) = 1").count()
    context = F.expr("substring(gram, 1, length(gram) - 1)").alias("context")
    totals = store(counts.groupBy(context).agg(F.sum("allow").alias("all_allow"), F.sum("block").alias("all_block")), "totals")
    levels = []
    for n in range(1, order + 2):
        level = strings.where(F.length("key") == n).withColumns({"context": F.substring("key", 1, n - 1), "rest": F.expr("substring(key, 2)")})
        level = level.join(counts, F.col("key") == F.col("gram"), "left").join(totals, "context", "left")
        if levels:
            level = level.join(levels[-1].select(F.col("key").alias("rest"), F.col("p").alias("p0"), F.col("q").alias("q0")), "rest")
        else:
            level = level.withColumns({"p0": F.lit(1.0 / alphabet), "q0": F.lit(1.0 / alphabet)})
        smoothed = {
            to: F.when(F.col(total).isNull(), F.col(to + "0")).otherwise((F.coalesce(count, F.lit(0)) + strength * F.col(to + "0")) / (F.col(total) + strength))
            for to, count, total in (("p", "allow", "all_allow"), ("q", "block", "all_block"))
        }
        levels.append(store(level.withColumns(smoothed).select("key", "p", "q"), "level"))
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    out = store(out.select("key", F.ln(F.col("p") / F.col("q")).alias("ratio")), "ratios")
    discard(strings, totals, *levels)
    return out


def address_scores(addresses: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """``address, score`` of every address. The sum is one of decimals, so that it doesn't depend on the rows' order."""
    ratios = log_ratios(address_keys(addresses, order), counts, order)
    sums = address_keys(addresses, order).join(ratios, "key").groupBy("id").agg(F.sum(F.col("ratio").cast("decimal(24,14)")).cast("double").alias("total"))
    sums = addresses.join(sums, "id", "left")
    return sums.select("address", (F.coalesce("total", F.lit(0.0)) / F.greatest(F.length("address") - 1, F.lit(1))).alias("score"))


class CharacterModels:
    """Two variable-order Markov models with common contexts.

    A character's probability after a context is its share there, smoothed towards its probability after the
    context without its first character, down to an even chance for each known character. Contexts that
    were not seen pass it on unchanged, so the order varies with what was seen. This is the plain version of
    :func:`log_ratios` for counts that fit one process.
    """

    def __init__(self, grams: dict[str, tuple[int, int]], order: int, strength: float = STRENGTH):
        self.grams, self.order, self.strength = grams, order, strength
        self.totals: dict[str, tuple[int, int]] = {}
        for gram, (a, b) in grams.items():
            x, y = self.totals.get(gram[:-1], (0, 0))
            self.totals[gram[:-1]] = (x + a, y + b)
        self.alphabet = 1 + sum(len(g) == 1 for g in grams)
        self.known: dict[str, float] = {}

    def ratio(self, context: str, character: str) -> float:
        """Log of the character's probability among accepted addresses over that among rejected ones."""
        p = q = 1.0 / self.alphabet
        for k in range(len(context) + 1):
            tail = context[len(context) - k :]
            total = self.totals.get(tail)
            if total is None:
                break
            a, b = self.grams.get(tail + character, (0, 0))
            p = (a + self.strength * p) / (total[0] + self.strength)
            q = (b + self.strength * q) / (total[1] + self.strength)
        return float(np.log(p / q))

    def score(self, address: str) -> float:
        """The mean over the address's characters."""
        total, known = 0.0, self.known
        for i in range(1, len(address)):
            key = address[max(0, i - self.order) : i + 1]
            if (r := known.get(key)) is None:
                if len(known) > 300_000:
                    known.clear()
                r = known[key] = self.ratio(key[:-1], key[-1])
            total += r
        return total / max(1, len(address) - 1)


def _threshold(scored: DataFrame) -> float:
    """The score from which fewest judged addresses are on the wrong side, both verdicts weighing alike."""
    rows = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.sum((F.col("verdict") == "allow").cast("long")).alias("a"), F.sum((F.col("verdict") == "block").cast("long")).alias("b")
    )
    rows = sorted(rows.collect())  # a mean of log ratios of smoothed shares stays within some 30 either way: at most 4,000 bins
    a, b = (np.array([r[k] for r in rows], float) for k in ("a", "b"))
    if not len(rows) or not a.sum() or not b.sum():
        return 0.0
    wrong = np.concatenate([[0], np.cumsum(a)]) / a.sum() + 1 - np.concatenate([[0], np.cumsum(b)]) / b.sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    edges = np.array([r["bin"] for r in rows] + [rows[-1]["bin"] + 1], float) * BIN
    return float((edges[best[0]] + edges[best[-1]]) / 2)


def judge_urls(df: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every URL.

    ``rules`` are pairs like ``("net/es/", "block")``: the longest that fits decides. Where none fits, two smoothed
    variable-order character models decide, learnt from the addresses (host from the top domain down, then path) that rules
    accept and reject: the mean log-likelihood difference per character against the threshold that separates the learnt addresses best.

    All strings are counted in Spark over all judged URLs, equal addresses first, and stay a written table. The distinct addresses'
    characters are joined with it, so nothing that grows with the URLs is sent to a task or to the driver.
    The threshold comes from counts of score bins. If the rules accept or reject nothing at all, the threshold is 0.

    A null URL or one without ``://`` has empty host and path, fits no rule and is judged by the models like others. Rows that
    are repeated or have no id are judged alike. An empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict}).withColumn("address", address())
    rows = store(rows, "addresses")
    addresses = store(distinct_addresses(rows), "distinct")
    counts = store(gram_counts(addresses, order), "grams")
    scored = store(rows.join(address_scores(addresses, counts, order), "address"), "scored")
    discard(rows, addresses, counts)
    threshold = _threshold(scored.where("verdict IS NOT NULL"))
    verdict = F.coalesce("verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
