"""Near duplicates by MinHash with tensored banding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.rows import quoted
from stratalake.llm.similar import FACTS, LONGS, set_facts, shingle_sets, similar_groups
from stratalake.llm.wordhash import Words, bounded_batches, mix, salted, signed, slices
from stratalake.sources.scratch import store

#: Sub-keys in each of the two collections; every pair of one from each is a table's key.
SUBKEYS = 12
#: Minimum hashes that make a sub-key.
HASHES = 2
PROFILE = T.StructType([*FACTS, *[T.StructField(c, LONGS) for c in ("left_keys", "right_keys")]])


def miss_chance(similarity: float, subkeys: int = SUBKEYS, hashes: int = HASHES) -> float:
    """Chance that sets of this similarity meet in no table: no sub-key of one collection is the same."""
    none = (1 - similarity**hashes) ** subkeys
    return 1 - (1 - none) ** 2


def collections(grams: np.ndarray, starts: np.ndarray, subkeys: int, hashes: int) -> list[np.ndarray]:
    """Two arrays (set, sub-key): each sub-key a hash of ``hashes`` minimum hashes of its own and of its place.

    ``starts`` are the first elements of the sets, none of them empty.
    """
    out, salt = [], 100
    for _ in range(2):
        keys = np.empty((len(starts), subkeys), np.uint64)
        for k in range(subkeys):
            key = np.full(len(starts), salt, np.uint64)
            for _ in range(hashes):
                salt += 1
                key = mix(key + np.minimum.reduceat(salted(grams, salt), starts))
            keys[:, k] = key
        out.append(keys)
    return out


def _profiles(width: int, percent: int, subkeys: int, hashes: int):
    def profile(batches):
        seen = set()  # sets of this partition: copies of one need no keys of their own
        for batch in batches:
            for low, high in slices(batch.column(1)):
                rows = high - low
                texts, grams = shingle_sets(Words(batch.column(1).slice(low, rows), lower=True), width)
                sizes = np.bincount(texts, minlength=rows)
                columns, new = set_facts(batch.column(0).slice(low, rows), texts, grams, sizes, percent, seen)
                kept = grams[new[texts]]
                own = sizes[new]
                keys = collections(kept, np.cumsum(own) - own, subkeys, hashes) if len(own) else [np.zeros(0, np.uint64)] * 2
                bounds = pa.array(np.concatenate([[0], np.cumsum(new * subkeys)]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(signed(k.ravel()))) for k in keys]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=PROFILE.names)

    return profile


def minhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 2, percent: int = 80, subkeys: int = SUBKEYS, hashes: int = HASHES
) -> DataFrame:
    """Groups of documents linked by ``percent`` % or more Jaccard similarity of their ``width``-word shingles.

    Returns ``doc_id, n_shingles, component_id, kept``: the size of the document's set, the smallest id that links reach from it, and whether that is its own. Texts are
    lower-cased (A-Z); a text of fewer words is one shingle.

    * Equal sets form a class first (by a 128-bit sum of 64-bit shingle hashes) and go on as one row.
    * Two collections of ``subkeys`` sub-keys, each of ``hashes`` minimum hashes, make ``subkeys ** 2`` tables: the key of table (i, j) combines sub-key i of one and j of
      the other. So 2 * 12 * 2 = 48 minimum hashes serve 144 tables of four hashes each, which by themselves would take 576. Two sets meet in
      a table if they share one sub-key of each collection; :func:`miss_chance` is 9.4e-6 at a similarity of 0.8 and 4.1e-7 at 0.85 with the defaults.
    * Candidates, confirmation on whole shingle sets and components are those of :func:`similar_groups`.

    A null or empty text has no shingles, links with nothing and is its own component. Rows of one id are versions of one document; those with text share its
    component. Rows without id have none and are kept. An empty table gives no rows; other columns are not read.
    """
    docs = bounded_batches(df).select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    profiles = store(docs.mapInArrow(_profiles(width, percent, subkeys, hashes), PROFILE), "profiles")
    keys = F.expr("flatten(transform(left_keys, x -> transform(right_keys, y -> xxhash64(x, y))))")
    groups = similar_groups(profiles, keys, F.size("left_keys") * F.size("right_keys"), docs, width, percent)
    return groups.withColumn("kept", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)))
