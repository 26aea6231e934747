"""Periodic runs of words, found with a dictionary of basic factors."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.rows import quoted
from stratalake.llm.wordhash import Words, bounded_batches, salted, slices

#: Words put together at a time when kept words are joined.
JOINED_WORDS = 1 << 17


def _extended(names: np.ndarray, start: int, period: int) -> tuple[int, int]:
    """The greatest stretch around ``start`` of places whose name is found again ``period`` places on: first and one past the last."""
    low, width = start, 16
    while low > 0:
        a = max(0, low - width)
        differ = np.flatnonzero(names[a:low] != names[a + period : low + period])
        if len(differ):
            low = a + int(differ[-1]) + 1
            break
        low, width = a, 2 * width
    high, width, last = start, 16, len(names) - period
    while high < last:
        b = min(last, high + width)
        differ = np.flatnonzero(names[high:b] != names[high + period : b + period])
        if len(differ):
            high += int(differ[0])
            break
        high, width = b, 2 * width
    return low, high


def periodic_runs(names: np.ndarray, longest: int, exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all maximal runs of a sequence, by start and period.

    A run is a stretch that repeats with a smallest period q, has max(shortest, exponent * q) places or more and can't be made longer keeping q.
    ``names`` are numbers that are equal where words are; several texts may follow each other if they share no number, the longest of them
    having ``longest`` places.

    * The dictionary of basic factors names every factor of 1, 2, 4, 8 … places: two factors of a length get one name if they are equal, and a factor's
      name follows from those of its halves. Factors that occur once can't be part of a longer one that occurs twice; they get no name, so
      the levels shrink to what is repeated.
    * In a run of period q the factors of the first level that is not shorter than q are next found q places on, since a primitive word is no inner factor of its square. So
      the next occurrences within twice a factor's length propose periods, where they form an arithmetic progression: the same distance
      again from there. ``exponent`` of 4 leaves room for two such steps.
    * The first place of each stretch of equal distances is extended to both sides by comparing names of words, and what several levels find counts once.
    """
    if exponent < 4:
        raise ValueError("runs of fewer than four periods may have no progression of three factors")
    n = len(names)
    names = np.asarray(names, np.int64)
    pos, key, length = np.arange(n), names, 1
    level, gap = np.empty(n, np.int64), np.empty(n + 1, np.int64)
    proposals = set()
    while len(pos) and 2 * length <= longest:
        order = np.argsort(key, kind="stable")
        where, sorted_key = pos[order], key[order]
        same = sorted_key[1:] == sorted_key[:-1]
        gap[:] = 0
        gap[where[:-1]] = np.where(same, where[1:] - where[:-1], 0)
        found = pos[(gap[pos] > 0) & (gap[pos] <= 2 * length)]
        found = found[gap[found + gap[found]] == gap[found]]
        found = found[(found == 0) | (gap[found - 1] != gap[found])]
        proposals.update(zip(found.tolist(), gap[found].tolist(), strict=True))

        twice = np.zeros(len(pos), bool)
        twice[1:] = same
        twice[:-1] |= same
        level[:] = -1
        rank = np.cumsum(np.concatenate([[0], ~same]))
        level[where[twice]] = rank[twice]
        pos = np.sort(where[twice])
        pos = pos[pos + length < n]
        pos = pos[level[pos + length] >= 0]
        key = level[pos] * (n + 1) + level[pos + length]
        length *= 2

    runs = set()
    for start, period in proposals:
        low, high = _extended(names, start, period)
        size = high - low + period
        if size >= max(shortest, exponent * period):
            runs.add((low, size, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def joined_digests(words: Words, picks: np.ndarray, bounds: np.ndarray) -> list[str]:
    """SHA-256 of each text's picked words joined by one blank; ``picks[bounds[i]:bounds[i + 1]]`` are the word numbers of text i."""
    data = np.append(words.data, np.uint8(32))
    digests = [hashlib.sha256() for _ in range(len(bounds) - 1)]
    for at in range(0, len(picks), JOINED_WORDS):
        some = picks[at : at + JOINED_WORDS]
        sizes = words.ends[some] - words.starts[some] + 1  # with the place after the word
        ends = np.cumsum(sizes)
        take = np.arange(ends[-1]) + np.repeat(words.starts[some] - (ends - sizes), sizes)
        joined = data[take]
        joined[ends - 1] = 32
        edge = np.concatenate([[0], ends])
        first, last = np.searchsorted(bounds, [at, at + len(some) - 1], "right") - 1
        for i in range(first, last + 1):
            a, b = max(bounds[i] - at, 0), min(bounds[i + 1] - at, len(some))
            if a < b:
                whole = at + b == bounds[i + 1]  # no blank after the last word
                digests[i].update(joined[edge[a] : edge[b] - whole])
    return [d.hexdigest() for d in digests]


def planted(doc_id: int, n: int) -> np.ndarray | None:
    """The word numbers of a text that, for one id in ten, repeats a stretch of its own words from some place to its end; else None."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "runs array<struct<start: long, length: long, period: long>>"
)


def _found(exponent: int, shortest: int, rewrite: Callable[[int, int], np.ndarray | None] | None):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                ids = batch.column(0).slice(low, high - low)
                words = Words(batch.column(1).slice(low, high - low))
                first, counts, texts = words.first, words.counts, words.texts()
                at = np.arange(len(texts))
                for i, doc in enumerate(ids.to_pylist() if rewrite else ()):
                    if doc is not None and (new := rewrite(doc, int(counts[i]))) is not None:
                        at[first[i] : first[i + 1]] = first[i] + new
                keys = salted(words.hashes()[at] ^ salted(texts.astype(np.uint64), 12), 11)
                names = np.unique(keys, return_inverse=True)[1] if len(keys) else np.zeros(0, np.int64)
                runs = [[] for _ in counts]
                edge = np.zeros(len(at) + 1, np.int64)
                for start, length, period in periodic_runs(names, int(counts.max(initial=0)), exponent, shortest):
                    i = texts[start]
                    runs[i].append((int(start - first[i]), length, period))
                    edge[start + period] += 1
                    edge[start + length] -= 1
                kept = np.cumsum(edge[:-1]) == 0
                bounds = np.concatenate([[0], np.cumsum(kept)])[first]
                rows = []
                for own in runs:
                    best = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
                    rows.append((len(own), *best, 1000 * best[1] // best[2] if own else None, hashlib.sha256(listed.encode()).hexdigest()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        *[pa.array(c, pa.int64()) for c in columns[:5]],
                        pa.array(columns[5], pa.string()),
                        pa.array(joined_digests(words, at[kept], bounds), pa.string()),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs], kind),
                    ],
                    names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs"],
                )

    return found


def find_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exponent: int = 4,
    shortest: int = 6,
    rewrite: Callable[[int, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """The periodic runs of every text's words, see :func:`periodic_runs`.

    Returns ``doc_id, n_runs``, the longest run's ``start, length, period, exponent_milli`` (thousandths of length / period; ties go to the smallest
    start, then period; null without runs), ``runs_sha256`` of the lines ``start,length,period``, ``collapsed_sha256`` of the text with every run cut to its
    first period (kept words joined by one blank), and ``runs`` themselves. ``rewrite(doc_id, n)`` may give the numbers of the words to use instead of the text's own n words.

    Every text is worked on by itself, with a slice of others, where it is read: nothing is shuffled, and a lost task is repeated from its input. Words stand as 64-bit
    hashes. A null or empty text has no words and no runs. Rows without id are not rewritten. Repeated rows and ids each give a row. An empty
    table gives no rows; other columns are not read.
    """
    docs = bounded_batches(df).select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    return docs.mapInArrow(_found(exponent, shortest, rewrite), SCHEMA)
