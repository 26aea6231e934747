"""Counting byte-level BPE tokens without making them."""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.bpefile import BpeFile, Splitter, byte_alphabet
from stratalake.llm.wordhash import bounded_batches, mix, range_hashes, slices

CACHED = 400_000


def pair_table(bpe: BpeFile) -> tuple[dict[int, int], list[int]]:
    """Rank by pair of symbols (as one number), and the symbol each rank makes."""
    pairs = {bpe.vocab[a] << 32 | bpe.vocab[b]: rank for rank, (a, b) in enumerate(bpe.merges)}
    return pairs, [bpe.vocab[a + b] for a, b in bpe.merges]


def tokens_left(symbols: list[int], pairs: dict[int, int], made: list[int]) -> int:
    """Symbols left after all merges: the lowest-ranked adjacent pair first, the leftmost of equals.

    A heap holds the pairs as rank and place in one number, a linked list the symbols; what comes from the
    heap and is no longer there is passed over.
    """
    n = left = len(symbols)
    rank_of = pairs.get
    heap = [r << 32 | i for i in range(n - 1) if (r := rank_of(symbols[i] << 32 | symbols[i + 1])) is not None]
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        top = heappop(heap)
        i, rank = top & 0xFFFFFFFF, top >> 32
        a, j = symbols[i], after[i]
        if a < 0 or j >= n or rank_of(a << 32 | symbols[j]) != rank:
            continue
        a = symbols[i] = made[rank]
        symbols[j] = -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := rank_of(a << 32 | symbols[k])) is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0 and (r := rank_of(symbols[h] << 32 | a)) is not None:
            heappush(heap, r << 32 | h)
    return left


class Counter:
    """Token counts of texts; each distinct piece is merged once while it is remembered."""

    def __init__(self, bpe: BpeFile):
        self.pairs, self.made = pair_table(bpe)
        self.symbols, self.splitter = [bpe.vocab[c] for c in byte_alphabet()], Splitter()
        names = sorted(bpe.special, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.known: dict[int, int] = {}

    def piece(self, text: str) -> int:
        symbols = self.symbols
        return tokens_left([symbols[b] for b in text.encode()], self.pairs, self.made)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. The texts are cut together; only distinct pieces are looked at one by one."""
        totals = np.zeros(len(texts), np.int64)
        parts, owners = [], []
        for i, text in enumerate(texts):
            cut = self.special.split(text) if self.special else [text]
            totals[i] += len(cut) - 1
            parts += cut
            owners += [i] * len(cut)
        cuts = [self.splitter.bounds(p) for p in parts]
        codes = np.concatenate([c for c, _ in cuts]) if cuts else np.zeros(0, np.uint32)
        lengths = np.array([len(c) for c, _ in cuts], np.int64)
        shifts = np.concatenate([[0], np.cumsum(lengths)])
        starts = np.concatenate([b + s for (_, b), s in zip(cuts, shifts, strict=False)]) if cuts else np.zeros(0, np.int64)
        if not len(starts):
            return totals
        owner = np.repeat(owners, [len(b) for _, b in cuts])
        ends = np.concatenate([starts[1:], shifts[-1:]])
        keys = range_hashes(mix(codes.astype(np.uint64)), starts, ends)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        whole = codes.astype("<u4").tobytes()
        sizes = np.empty(len(distinct), np.int64)
        known = self.known
        for j, (key, a, b) in enumerate(zip(distinct.tolist(), starts[first].tolist(), ends[first].tolist(), strict=True)):
            size = known.get(key)
            if size is None:
                if len(known) >= CACHED:
                    known.clear()
                size = known[key] = self.piece(whole[4 * a : 4 * b].decode("utf-32-le"))
            sizes[j] = size
        np.add.at(totals, owner, sizes[inverse])
        return totals


def _count(path: str):
    def count(batches):
        counter = Counter(BpeFile(path))
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                tokens = counter.counts([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    return count


def token_counts(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text, as the byte-level BPE file at ``path`` cuts it.

    The count is the number of bytes less the merges that the file's rules make, found piece by piece
    (:func:`tokens_left`); no ids are made. The file's special strings count as one token wherever they stand. A null or empty
    text has no bytes and no tokens; repeated rows and rows without id are counted like others. The file must be there
    on every executor.
    """
    docs = bounded_batches(df).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sized = docs.mapInArrow(_count(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    return sized.withColumn("over_limit", F.col("n_tokens") > limit)
