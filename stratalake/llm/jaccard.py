"""Joining documents by n-gram Jaccard similarity with parity sketches."""

from __future__ import annotations

from functools import cache
from math import ceil, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.rows import quoted
from stratalake.llm.similar import FACTS, LONGS, set_facts, shingle_sets, similar_groups
from stratalake.llm.wordhash import Words, bounded_batches, mix, salted, signed, slices
from stratalake.sources.scratch import store

PROFILE = T.StructType([*FACTS, T.StructField("signatures", LONGS)])
#: Chance that a set is dealt into too few blocks of every partition of its band.
FEW_BLOCKS = 1e-9
#: Blocks to try, as multiples of the least number.
_WIDER = (1, 1.02, 1.05, 1.1, 1.15, 1.2, 1.3, 1.4, 1.5, 1.75, 2, 2.5, 3, 4, 6, 8, 12)
_EXACT = 400


def chance_of_few(n: int, blocks: int, most: int) -> float:
    """Chance that ``n`` elements dealt by hash leave at most ``most`` blocks with an element; by a normal law for large sets."""
    if most >= min(n, blocks):
        return 1.0
    if n <= _EXACT:
        p, k = np.zeros(blocks + 1), np.arange(blocks + 1)
        p[0] = 1
        for _ in range(n):
            q = p * k / blocks
            q[1:] += p[:-1] * (blocks - k[:-1]) / blocks
            p = q
        return float(p[: most + 1].sum())
    empty = (1 - 1 / blocks) ** n
    mean = blocks * (1 - empty)
    spread = blocks * empty * (1 - empty) + blocks * (blocks - 1) * ((1 - 2 / blocks) ** n - empty**2)
    return 0.5 * (1 + erf((most + 0.5 - mean) / sqrt(2 * max(spread, 1e-9))))


@cache
def size_bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Least and greatest set size, blocks of a partition and number of partitions of every band.

    Sets with similarity of ``percent`` % or more, the larger one in a band up to ``high``, differ in at most ``(100 - percent) / (100 + percent) * 2 * high``
    elements, and so in at most as many blocks of a partition. If the larger one has elements in more blocks than that, one of these is the same in
    both. Blocks and partitions are chosen so that this fails for all partitions of a band with a chance of ``FEW_BLOCKS`` at most, and so
    that a set has as few filled blocks as that allows. So only blocks with elements need a signature, and sets that share no element share none.
    """
    low, bands = 1, []
    growth = 14 if percent >= 70 else 11
    while low < 1 << 40:
        high = max(low, low * growth // 10)
        differ = 2 * high * (100 - percent) // (100 + percent)
        best = None
        for wider in _WIDER:
            blocks = ceil((differ + 1) * wider)
            few = chance_of_few(low, blocks, differ)
            if few < 0.5:
                partitions = 1 if few <= FEW_BLOCKS else ceil(log(FEW_BLOCKS) / log(few))
                filled = partitions * blocks * (1 - (1 - 1 / blocks) ** low)
                best = min(best or (filled, blocks, partitions), (filled, blocks, partitions))
        bands.append((low, high, *best[1:]))
        low = high + 1
    return tuple(np.array(x, np.int64) for x in zip(*bands, strict=True))


def block_signatures(texts: np.ndarray, grams: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of every block with elements: the XOR of the hashes that fall into it, in each band the text can match in."""
    lows, _, blocks, partitions = size_bands(percent)
    own = np.searchsorted(lows, sizes, "right") - 1
    last = np.searchsorted(lows, sizes * 100 // percent, "right") - 1
    owners, signatures = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for step in range(int((last - own).max(initial=-1)) + 1):
        band = own + step
        used = (sizes > 0) & (band <= last)
        band = np.where(used, band, 0)
        for partition in range(int(partitions[band].max(initial=0))):
            here = used & (partition < partitions[band])
            m = np.where(here, blocks[band], 0)
            first = np.concatenate([[0], np.cumsum(m)])
            take = here[texts]
            slot = first[texts[take]] + (salted(grams[take], 20 + partition) % m[texts[take]].astype(np.uint64)).astype(np.int64)
            value = np.zeros(first[-1], np.uint64)
            np.bitwise_xor.at(value, slot, grams[take])
            filled = np.flatnonzero(np.bincount(slot, minlength=first[-1]))
            owner = np.repeat(np.arange(len(sizes)), m)[filled]
            tag = (band[owner] << 50) + (partition << 42) + filled - first[owner]
            owners.append(owner)
            signatures.append(mix(value[filled] ^ salted(tag.astype(np.uint64), 2)))
    return np.concatenate(owners), np.concatenate(signatures)


def _profiles(width: int, percent: int):
    def profile(batches):
        seen = set()  # sets of this partition: copies of one need no signatures of their own
        for batch in batches:
            for low, high in slices(batch.column(1)):
                ids = batch.column(0).slice(low, high - low)
                texts, grams = shingle_sets(Words(batch.column(1).slice(low, high - low), lower=True), width)
                sizes = np.bincount(texts, minlength=high - low)
                columns, new = set_facts(ids, texts, grams, sizes, percent, seen)
                owners, signatures = block_signatures(texts, grams, np.where(new, sizes, 0), percent)
                order = np.argsort(owners, kind="stable")
                bounds = np.searchsorted(owners[order], np.arange(high - low + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(signed(signatures[order])))
                yield pa.RecordBatch.from_arrays([*columns, found], names=PROFILE.names)

    return profile


def jaccard_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, count_links: bool = False) -> DataFrame:
    """Groups of documents linked by ``percent`` % or more Jaccard similarity of their ``width``-word shingles.

    Returns ``doc_id, n_shingles, component_id``: the size of the document's set and the smallest id that links reach
    from it. With ``count_links`` also ``n_links``, to how many different sets the document's set is linked. Texts are lower-cased (A-Z); a text of fewer words is one shingle.

    * Sets that are equal form a class first (by a 128-bit sum of shingle hashes), so that copies cost one row.
    * Every set is cut into blocks by hash and each block XORed into one value: a sketch whose blocks differ in at most
      as many places as the sets differ. Sets alike enough share a block with elements by the pigeonhole rule, per band of sizes (see :func:`size_bands`).
    * A second sketch of parity bits, as wide as the set needs, gives a lower bound of the difference and drops hopeless pairs.
    * Candidates, confirmation on whole sets (64-bit hashes of the shingles) and components are those of :func:`similar_groups`. To count links all members of a
      bucket are compared, which grows with the square of a group's different sets.

    A null or empty text has no shingles, links with nothing and is its own component. Rows with one id are taken for
    versions of one document; those with text share its component. Rows without id get a null component. An empty table gives no rows.
    """
    docs = bounded_batches(df).select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    profiles = store(docs.mapInArrow(_profiles(width, percent), PROFILE), "profiles")
    return similar_groups(profiles, F.col("signatures"), F.size("signatures"), docs, width, percent, count_links)
