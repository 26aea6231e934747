"""Auditing how filters act on each other in every order they could be applied in."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.rows import quoted
from stratalake.llm.wordhash import bounded_batches
from stratalake.sources.scratch import store

#: Bytes of one text split into words at a time.
PIECE_BYTES = 1 << 20
#: More filters would mean more than 720 orders.
MOST_FILTERS = 6
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point


def word_pieces(raw: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, some ``size`` bytes of it at a time, so that a long text is never a list of all its words."""
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + size)
        end = space.start() if space else len(raw)
        yield raw[at:end].split()  # of bytes, split() takes exactly the white space of the word pattern
        at = end


def text_failures(raw: bytes) -> int:
    """Bits of the failed filters A (1), B (2), C (4) and D (8) of one text."""
    n, distinct = 0, set()
    for words in word_pieces(raw):
        n += len(words)
        distinct.update(words)
    upper = len(raw) - len(raw.translate(None, _UPPER))
    points = len(raw.translate(None, _CONTINUATION))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return (n < 100) | (100 * len(distinct) < 80 * n) << 1 | (100 * upper > 10 * points) << 2 | (symbols > 0) << 3


def _facts(batches):
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        flags, digests = [], []
        for text in texts:
            raw = text.as_py() or b""
            flags.append(text_failures(raw))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(flags, pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "part", "flags", "digest"],
        )


def document_failures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part`` and a boolean for each of the five filters: true where the document fails it.

    A: under 100 words; B: under 80 % distinct words; C: over 10 % upper-case letters of all characters; D: one of ``#$%&*|``;
    E: the text of a document of smaller id. A null text counts as empty, a null part as the empty string. Rows without id
    fail no E and are nobody's earlier text; rows of one id and text don't precede each other. Equal texts are found by their SHA-256.
    """
    docs = bounded_batches(df).select(
        quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"), F.coalesce(quoted(part_col), F.lit("")).alias("part")
    )
    facts = store(docs.mapInArrow(_facts, "doc_id long, part string, flags int, digest binary"), "facts")
    # Only texts held twice are joined back; the table is written, so a text that a third of all rows share can be split.
    copies = facts.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    both = facts.join(store(copies, "copies"), "digest", "left")
    bits = {name: F.expr(f"flags & {1 << i} != 0") for i, name in enumerate("ABCD")}
    return both.select("doc_id", "part", *[c.alias(n) for n, c in bits.items()], F.coalesce(F.expr("doc_id > first"), F.lit(False)).alias("E"))


def orders(filters: Sequence[str]) -> list[tuple[int, ...]]:
    """Every order of the filters' positions."""
    return list(itertools.permutations(range(len(filters))))


@cache
def packed(mask: int, n_filters: int, n_losses: int) -> int:
    """One integer whose 64-bit fields are what happens to a document of this mask at every step of every order.

    The mask's low bits say which filters fail, the next ones which losses the document counts as. The fields of a step are kept, removed, redundant,
    unique_fails and each loss, 0 or 1. A sum of such integers over fewer than 2**63 documents never carries from one field into the next.
    """
    fields = []
    for order in itertools.permutations(range(n_filters)):
        gone = False
        for f in order:
            fails = bool(mask >> f & 1)
            removed = fails and not gone
            gone = gone or fails
            alone = mask & ((1 << n_filters) - 1) == 1 << f
            fields += [not gone, removed, fails and not removed, alone]
            fields += [removed and bool(mask >> n_filters + i & 1) for i in range(n_losses)]
    return int.from_bytes(np.array(fields, "<i8").tobytes(), "little")


def unpacked(total: int, n_filters: int, n_losses: int) -> np.ndarray:
    """The fields of a sum of packed integers, as (order, step, measure)."""
    width = 4 + n_losses
    n_orders = len(orders(range(n_filters)))
    return np.frombuffer(total.to_bytes(8 * n_orders * n_filters * width, "little"), "<i8").reshape(n_orders, n_filters, width)


def audit_filters(failures: DataFrame, filters: Sequence[str], losses: Mapping[str, str], part: str = "part") -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``failures`` has a boolean column per filter (true: the row fails it) and per loss (``{output: column}``; true: removing the
    row is a loss of that kind). Returns ``part, filter_order, step, kept, removed, redundant, unique_fails, <losses>, shapley``, one row for each
    part, order and step; the filter of a step is that letter of ``filter_order``. ``shapley`` is what the step's filter removes in sum over all orders.

    Rows are counted per part and mask (with map-side combining, so a part that holds most rows is at most
    2 ** (filters + losses) rows per task). Each mask has one packed integer; those of a part are summed, each as often as it was counted,
    and the sum's fields are the result. A null flag counts as false, a null part as the empty string. No rows give no rows.
    """
    filters, names = list(filters), list(losses)
    if not 1 <= len(filters) <= MOST_FILTERS or len(set(filters)) < len(filters):
        raise ValueError(f"from 1 to {MOST_FILTERS} different filters")
    columns = [*filters, *losses.values()]
    mask = sum((F.when(quoted(c), 1 << i).otherwise(0) for i, c in enumerate(columns)), F.lit(0))
    counts = failures.select(F.coalesce(quoted(part), F.lit("")).alias("part"), mask.cast("int").alias("mask")).groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    n_filters, n_losses = len(filters), len(names)

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(packed(int(m), n_filters, n_losses) * int(n) for m, n in zip(rows["mask"], rows["n"], strict=True))
        found = unpacked(total, n_filters, n_losses)
        every = orders(filters)
        at = np.array(every).ravel()
        removed = np.zeros(n_filters, np.int64)
        np.add.at(removed, at, found[:, :, 1].ravel())
        out = {
            "part": rows["part"].iloc[0],
            "filter_order": np.repeat(["".join(filters[f] for f in o) for o in every], n_filters),
            "step": np.tile(np.arange(1, n_filters + 1, dtype=np.int32), len(every)),
        }
        out |= {name: found[:, :, i].ravel() for i, name in enumerate(["kept", "removed", "redundant", "unique_fails", *names])}
        return pd.DataFrame(out | {"shapley": removed[at]})

    measures = ", ".join(f"`{n}` long" for n in ["kept", "removed", "redundant", "unique_fails", *names, "shapley"])
    return counts.groupBy("part").applyInPandas(steps, f"part string, filter_order string, step int, {measures}")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of :func:`document_failures` by language, with lost good and lost toxic documents.

    A document is good or toxic if any row of ``labels`` with its id says so; without label, or without id, it is neither.
    """
    facts = document_failures(docs)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic")
    )
    return audit_filters(facts.join(marks, "doc_id", "left"), "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"})
