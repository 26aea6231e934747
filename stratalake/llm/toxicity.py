"""Toxic passages by maximum-scoring segments of word log-odds, and a text score by extreme-value statistics."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.language import held_out
from stratalake.llm.wordhash import bounded_batches, slices
from stratalake.sources.scratch import discard, store

LETTERS = re.compile(r"[^\W\d_]+")
#: Most labelled rows the model is made from.
MAX_LABELLED = 20_000
#: Significant tokens that a model may have; more are an error, since every task holds them. A token needs some ten different
#: neighbourhoods to be significant, so texts of ordinary length have far fewer.
MAX_TOKENS = 1_000_000
#: A word's tokens are itself and its beginnings of these lengths (with a hyphen), so that inflected words share one.
STEMS = range(4, 9)
CACHED = 300_000
#: Weight of the prior, in contexts; least significance of a word; cost of each other word.
PRIOR = 20.0
LEAST_Z = 4.0
DRIFT = 0.1


def maximal_segments(places: list[int], gains: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first place, last place, score), in linear time.

    ``places`` are ascending, ``gains`` the positive scores there; every place between costs ``drift``. Each
    candidate keeps the running totals at its left and right end. A new one is merged with the nearest
    earlier candidate of lower left total as long as that one's right total is lower too.
    """
    found: list[list] = []  # first, last, total before, total after, index of the nearest earlier one of lower total before
    total, at = 0.0, 0
    for place, gain in zip(places, gains, strict=True):
        total -= drift * (place - at)
        new = [place, place, total, total + gain, -1]
        total, at = total + gain, place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


class Model:
    """Scores of words, the extreme-value parameters and the last logistic step."""

    def __init__(self, gains: dict[str, float], rate: float = 1.0, size: float = 1.0, weights: tuple[float, float] = (0.0, 0.0)):
        self.gains, self.rate, self.size, self.weights = gains, rate, size, weights
        self.known: dict[str, float] = {}

    def gain(self, word: str) -> float:
        """Of the longest token of the word that has one."""
        tokens = [word, *(word[:k] + "-" for k in reversed(STEMS) if k < len(word))]
        return next((g for t in tokens if (g := self.gains.get(t)) is not None), 0.0)

    def hits(self, text: str | None) -> tuple[int, list[int], list[float]]:
        """The number of words, and where those with a gain stand."""
        words = LETTERS.findall((text or "").lower())
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.gain(w)
        gains = [known[w] for w in words]
        places = [i for i, g in enumerate(gains) if g]
        return len(words), places, [gains[i] for i in places]

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        n, places, gains = self.hits(text)
        return n, maximal_segments(places, gains, DRIFT)

    def surprise(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """Minus the log chance that clean text of this length has so high a best segment, and less for each further one."""
        total = 0.0
        for rank, score in enumerate(sorted((s for _, _, s in segments), reverse=True), 1):
            expected = self.size * max(n, 1) * np.exp(-self.rate * score)
            chance = -np.expm1(-expected)
            if rank > 1 and chance > 0.05:
                break
            total -= np.log(max(chance, 1e-300))
        return float(total)

    def score(self, surprise: float) -> float:
        a, b = self.weights
        return float(1 / (1 + np.exp(-np.clip(a + b * np.log1p(surprise), -30, 30))))


def _contexts(batches):
    """Words of labelled texts with a hash of the word before and after, once for each label while there is room."""
    import xxhash

    seen: set[tuple[str, str, str, int]] = set()

    def rows():
        contexts = [xxhash.xxh64_intdigest(f"{a} {c}") - (1 << 63) for a, _, c, _ in seen]
        out = [pa.array([s[1] for s in seen], pa.string()), pa.array(contexts, pa.int64()), pa.array([s[3] for s in seen], pa.int32())]
        seen.clear()
        return pa.RecordBatch.from_arrays(out, names=["word", "context", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = ["", *LETTERS.findall((text or "").lower()), ""]
            seen.update(zip(words, words[1:], words[2:], [toxic] * (len(words) - 2), strict=False))
            if len(seen) > CACHED:
                yield rows()
    yield rows()


def _significant(counts: DataFrame, share: float) -> DataFrame:
    """``token, odds`` of all those used significantly more in toxic contexts."""
    odds = F.log((F.col("t") + PRIOR * share) / (F.col("c") + PRIOR * (1 - share))) - float(np.log(share / (1 - share)))
    spread = F.sqrt(1 / (F.col("t") + PRIOR * share) + 1 / (F.col("c") + PRIOR * (1 - share)))
    best = counts.select("token", odds.alias("odds"), (odds / spread).alias("z")).where(f"z >= {LEAST_Z} AND odds > {2 * DRIFT}")
    return store(best.select("token", "odds"), "tokens")


def token_gains(labelled: DataFrame) -> dict[str, float]:
    """Significant tokens' log-odds less the drift.

    A word counts once for each pair of neighbours it has in toxic and in clean texts, so copies and near copies of
    one text don't make its words look toxic. The Dirichlet prior expects both classes to use a token alike.
    Stems are first counted over all their words, then, twice, over those that have no longer significant token.
    """
    each = labelled.select("text", "toxic").mapInArrow(_contexts, "word string, context long, toxic int")
    both = each.groupBy("word", "context").agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("c"))
    words = store(both.groupBy("word").agg(F.sum("t").cast("double").alias("t"), F.sum("c").cast("double").alias("c")), "words")
    toxic, clean = words.agg(F.coalesce(F.sum("t"), F.lit(0.0)), F.coalesce(F.sum("c"), F.lit(0.0))).first()
    if not toxic or not clean:
        return {}
    stems = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("-"))) for k in STEMS]
    tokens = words.select("word", "t", "c", F.explode(F.array_compact(F.array("word", *stems))).alias("token"))
    tally = [F.sum("t").alias("t"), F.sum("c").alias("c")]
    share = toxic / (toxic + clean)
    found = _significant(tokens.groupBy("token").agg(*tally), share)
    for _ in range(2):
        rank = F.when(F.col("token") == F.col("word"), 1 << 20).otherwise(F.length("token"))
        owned = tokens.join(found, "token").groupBy("word", "t", "c").agg(F.max_by("token", rank).alias("token"))
        found = _significant(owned.groupBy("token").agg(*tally), share)
    if found.count() > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} significant tokens")
    return {r["token"]: r["odds"] - DRIFT for r in found.collect()}


def decay(s: np.ndarray, times: np.ndarray, words: float) -> float:
    """The rate at which chances of high segments fall in clean text: the positive root of E[exp(rate * score)] = 1.

    The different gains ``s`` are met ``times`` times each in ``words`` words of clean text.
    """
    p = times / max(words, 1.0)
    p = p * min(1.0, 0.5 / max(p.sum(), 1e-300))
    rest = 1 - p.sum()
    f = lambda x: float((p * np.exp(np.minimum(x * s, 500))).sum() + rest * np.exp(-x * DRIFT) - 1)
    low, high = 1e-6, 50.0
    if f(low) >= 0:
        return low
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return low


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve, by Newton steps with a slight ridge."""
    design = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - 1e-2 * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _best(model: Model):
    """Of each labelled text its words and best segment; of the clean ones of a batch how often each gain is met."""

    def best(batches):
        for batch in batches:
            met = Counter()
            rows = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, places, gains = model.hits(text)
                rows.append((None, n, max((s for _, _, s in maximal_segments(places, gains, DRIFT)), default=0.0), toxic))
                if not toxic:
                    met.update(gains)
            rows += [(gain, times, None, None) for gain, times in met.items()]
            kinds = [pa.float64(), pa.int64(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=["gain", "n", "top", "toxic"])

    return best


def _surprises(model: Model):
    def surprises(batches):
        for batch in batches:
            found = [(*model.segments(text), toxic) for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            found = [(model.surprise(n, segments), toxic) for n, segments, toxic in found if n]
            yield pa.RecordBatch.from_pydict({"x": pa.array([x for x, _ in found], pa.float64()), "toxic": pa.array([t for _, t in found], pa.int32())})

    return surprises


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from ``doc_id, text`` and ``doc_id, toxic``, of at most ``MAX_LABELLED`` labelled rows chosen by a hash of the id."""
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sample = store(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED), "sample")
    labelled = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")  # at most MAX_LABELLED rows of two numbers
    model = Model(token_gains(labelled))
    found = store(labelled.mapInArrow(_best(model), "gain double, n long, top double, toxic int"), "best")
    # Ids may repeat, so the rows are bounded once more: numbers of MAX_LABELLED rows reach the driver.
    rows = found.where("gain IS NULL AND n > 0").select("n", "top", "toxic").orderBy(F.xxhash64("n", "top", "toxic"), "n", "top", "toxic").limit(MAX_LABELLED).collect()
    if not rows:
        model.weights = (-30.0, 0.0)
        return model
    n, top, toxic = (np.array([r[k] for r in rows], float) for k in ("n", "top", "toxic"))
    if toxic.min() == toxic.max():
        model.weights = (30.0 if toxic.max() else -30.0, 0.0)
        return model
    met = {r["gain"]: r["times"] for r in found.where("gain IS NOT NULL").groupBy("gain").agg(F.sum("n").alias("times")).collect()}  # a number a token
    if model.gains:
        highest = max(model.gains.values())
        met[highest] = met.get(highest, 0) + 1
        values = sorted(met)
        model.rate = decay(np.array(values), np.array([met[v] for v in values], float), float(n[toxic == 0].sum()))
    # Given the rate, n * exp(-rate * best) of clean texts is exponential with mean 1 / size.
    model.size = float(1 / np.mean(np.sort((n * np.exp(-model.rate * top))[toxic == 0])))
    scored = labelled.mapInArrow(_surprises(model), "x double, toxic int").orderBy(F.xxhash64("x", "toxic"), "x", "toxic").limit(MAX_LABELLED).collect()
    model.weights = logistic(np.log1p([r["x"] for r in scored]), np.array([r["toxic"] for r in scored], float))
    discard(found)
    return model


def _judge(model: Model):
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def judge(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                rows = [model.segments(t) for t in part.column(1).to_pylist()]
                scores = [model.score(model.surprise(n, found)) for n, found in rows]
                spans = [[{"first": a, "last": b, "score": s} for a, b, s in found] for _, found in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(spans, kind)],
                    names=["doc_id", "held_out", "score", "predicted", "segments"],
                )

    return judge


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", parts: int = 5, part: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted, segments``: how likely each text is toxic, and its toxic passages.

    Log-odds of words and of their beginnings (:data:`STEMS`) between toxic and clean labelled texts, with a Dirichlet prior, are learnt from labels whose
    ids are not held out (at most ``MAX_LABELLED``). A linear-time scan finds every maximal segment of
    each whole text, as first and last word (letter runs) and score. The chance of so high a segment in clean text of that
    length follows from an extreme-value law fitted to clean texts; a logistic curve over the logs makes the score. No other column is read.

    Null and empty texts have no segments and the score of a text without any. Labels without id or value don't count; if labels of
    one id differ, it is toxic. Without labels of both kinds, every score is next to 0, or 1 if all are toxic. Repeated rows and rows without id are scored alike. An empty
    table gives no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    docs = bounded_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("toxic")).where(~held_out(F.col("doc_id"), parts, part))
    model = fit(docs, known)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), parts, part).alias("held_out"))
    spans = "array<struct<first:bigint,last:bigint,score:double>>"
    return rows.mapInArrow(_judge(model), f"doc_id {kind}, held_out boolean, score double, predicted int, segments {spans}")
