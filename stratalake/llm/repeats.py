"""Removing word passages that occur earlier in the corpus."""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.rows import quoted, row_struct
from stratalake.llm.wordhash import Words, bounded_batches, range_hashes, salted, signed, slices
from stratalake.sources.scratch import discard, store

#: Words of the shortest windows, at most.
SHORTEST = 5
#: A place is a version of the document, told by some bits of its words' hash, and a word number.
_MARK_BIT = 40
_NUMBER = (1 << _MARK_BIT) - 1
#: The word number that stands for all words.
_ALL = _NUMBER
_LONGS = T.ArrayType(T.LongType(), False)
TEXTS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n", "one", "two")] + [T.StructField(c, _LONGS) for c in ("hashes", "places")])


def window_lengths(length: int) -> list[int]:
    """Lengths of the levels: each at most twice the one before, from ``SHORTEST`` words or fewer up to ``length``."""
    if length < 1:
        raise ValueError("a window has a word at least")
    halvings = 0
    while -(-length >> halvings) > SHORTEST:
        halvings += 1
    return [-(-length // (1 << k)) for k in range(halvings, -1, -1)]


def _marks(hashes: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's whole word sequence."""
    bounds = words.first
    one = range_hashes(hashes, bounds[:-1], bounds[1:])
    return one, range_hashes(salted(hashes, 7), bounds[:-1], bounds[1:])


def _versions(one: np.ndarray) -> np.ndarray:
    return (one & np.uint64(0x3FFFFF)).astype(np.int64) << _MARK_BIT


def level_starts(words: Words, hashes: np.ndarray, lengths: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """First words of all windows of the last length, and of the shorter window that stands for each on every level.

    Of the shortest windows in a full one the one with the least hash stands for it, so equal full windows have equal ones at the same
    place; a longer one holds the shorter one in its middle, as far as the full window allows.
    """
    full, least = lengths[-1], lengths[0]
    starts = np.arange(max(len(hashes) - full + 1, 0))
    texts = words.texts()
    starts = starts[texts[starts] == texts[starts + full - 1]] if len(starts) else starts
    if not len(starts):
        return starts, [starts for _ in lengths]
    at = np.arange(len(hashes) - least + 1)
    order = salted(range_hashes(hashes, at, at + least), 8)
    offset = np.lib.stride_tricks.sliding_window_view(order, full - least + 1)[starts].argmin(axis=1)
    levels, before = [starts + offset], least
    for length in lengths[1:]:
        offset = np.clip(offset - (length - before) // 2, 0, full - length)
        levels.append(starts + offset)
        before = length
    return starts, levels


def _places(words: Words, starts: np.ndarray, versions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each window, and its place."""
    texts = words.texts()[starts]
    return texts, versions[texts] + starts - words.first[texts]


def _lists(texts: np.ndarray, rows: int, *values: np.ndarray) -> list[pa.Array]:
    """Values in order of text as a list for each of ``rows`` texts."""
    bounds = pa.array(np.searchsorted(texts, np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in values]


def _shortest(lengths: list[int]):
    """Of every text: the hashes of its word sequence, and of its shortest windows that stand for a full one."""

    def shortest(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                words = Words(batch.column(1).slice(low, high - low))
                hashes = words.hashes()
                one, two = _marks(hashes, words)
                _, levels = level_starts(words, hashes, lengths)
                starts = np.unique(levels[0])
                texts, places = _places(words, starts, _versions(one))
                found = _lists(texts, high - low, signed(range_hashes(hashes, starts, starts + lengths[0])), places)
                facts = [pa.array(words.counts.astype(np.int64)), pa.array(signed(one)), pa.array(signed(two))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *facts, *found], names=TEXTS.names)

    return shortest


def _longer(lengths: list[int], level: int):
    """Hashes of the windows of a level in which the window of the level before is repeated; ``repeated`` are the places of those."""

    def longer(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                words = Words(part.column(1))
                hashes = words.hashes()
                one, _ = _marks(hashes, words)
                _, levels = level_starts(words, hashes, lengths)
                texts, places = _places(words, levels[level - 1], _versions(one))
                lists = part.column(2)
                known = lists.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy(zero_copy_only=False))
                # Places of different texts of a slice are kept apart by the text's number.
                hit = np.isin(_pairs(texts, places), _pairs(owner, known))
                starts = np.unique(levels[level][hit])
                texts, places = _places(words, starts, _versions(one))
                found = range_hashes(hashes, starts, starts + lengths[level])
                ids = part.column(0).take(pa.array(texts))
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), ids, pa.array(places)], names=["hash", "doc_id", "place"])

    return longer


def _pairs(texts: np.ndarray, places: np.ndarray) -> np.ndarray:
    return salted(places.astype(np.uint64), 13) ^ salted(texts.astype(np.uint64), 14)


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows ``hash, doc_id, place`` of a written table whose hash more than one of them has.

    Hashes are counted with map-side combining and joined back, so one that a third of all documents hold can be split.
    """
    often = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("hash")
    often = store(often, "often")
    kept = store(rows.join(often, "hash"), "repeated")
    discard(rows, often)
    return kept


def _cut(length: int, names: list[str]):
    def cut(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                part = batch.slice(low, high - low)
                words = Words(part.column(1))
                one, _ = _marks(words.hashes(), words)
                versions, counts = _versions(one), words.counts
                kept, digests, removed = [], [], []
                rows = zip(part.column(1), part.column(2), strict=True)
                for i, (text, found) in enumerate(rows):
                    raw = (text.as_py() or "").encode()
                    gone = np.zeros(counts[i], bool)
                    if found.is_valid:
                        places = found.values.to_numpy(zero_copy_only=False)
                        places = places[places >> _MARK_BIT << _MARK_BIT == versions[i]] & _NUMBER
                        if (places == _ALL).any():
                            gone[:] = True
                        else:
                            edge = np.zeros(counts[i] + 1, np.int64)
                            places = np.unique(places)
                            edge[places] += 1
                            edge[places + length] -= 1
                            gone = np.cumsum(edge[:-1]) > 0
                    left = raw.split()
                    if gone.any():
                        left = list(compress(left, (~gone).tolist()))
                        begins = words.starts[words.first[i] : words.first[i + 1]] - words.bounds[i]
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                        begins = np.append(begins, len(raw))
                        at, pieces = 0, []
                        for a, b in zip(edges[::2], edges[1::2], strict=True):
                            pieces.append(raw[at : begins[a]])
                            at = begins[b]
                        raw = b"".join([*pieces, raw[at:]])
                    kept.append(raw.decode() if text.is_valid else None)
                    digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
                    removed.append(int(gone.sum()))
                out = [part.column(0), pa.array(counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*out, *part.columns[3:]], names=names)

    return cut


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, carry: bool = False) -> DataFrame:
    """Every document without the words of windows of ``length`` words that start earlier in the corpus.

    Earlier means in a document of smaller id or further up in the same one; windows are judged on the
    input. Returns ``doc_id, n_words, n_removed, kept_sha256, kept_text``: the digest is of the kept words joined by one blank,
    the text keeps its own white space.

    * A document whose whole word sequence is that of a smaller id goes as a whole; this costs one aggregation.
    * The others go through levels of doubled lengths (5, 10 and 20 words for 20; see :func:`window_lengths`). On the first level one of the shortest windows stands for
      each full window, the one with the least hash, which is the same wherever the full window occurs. Windows that occur twice at one length are alone
      extended to the next, until none are left or the full length is reached. What a level passes on are places; texts are read again for the documents that have some.
    * Of equal full windows (64-bit hashes) the earliest is found with map-side combining and joined back.

    Null and empty texts have no words and stay. Rows without id take no part and stay whole. Equal rows of one id
    don't remove each other; different texts of one id are told apart by a hash of their words. Texts of fewer words than ``length``
    have no windows. With ``carry`` a column ``row`` holds the other input columns, whatever their names. An empty table gives no rows.
    """
    lengths = window_lengths(length)
    docs = bounded_batches(df).select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    texts = store(docs.mapInArrow(_shortest(lengths), TEXTS), "texts")
    long = texts.where(f"n >= {length} AND doc_id IS NOT NULL")
    kind = ["n", "one", "two"]
    copies = store(long.groupBy(*kind).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last"), "copies")
    version = F.shiftleft(F.expr("one & 4194303"), _MARK_BIT)
    whole = store(long.join(copies, kind).where("doc_id != first").select("doc_id", version.bitwiseOR(F.lit(_ALL)).alias("place")), "whole")

    later_copies = copies.select(*kind, F.col("first"))
    alone = long.join(later_copies, kind, "left").where("first IS NULL OR doc_id = first")
    rows = alone.select("doc_id", F.explode(F.arrays_zip("hashes", "places")).alias("w")).select(F.col("w.hashes").alias("hash"), "doc_id", F.col("w.places").alias("place"))
    found = _repeated(store(rows, "shortest"))
    discard(texts, copies)
    for level in range(1, len(lengths)):
        lists = found.groupBy("doc_id").agg(F.collect_list("place").alias("repeated"))  # a document's own windows
        lists = store(lists, "lists")
        discard(found)
        if lists.isEmpty():
            found = store(lists.select(F.lit(0).cast("long").alias("hash"), "doc_id", F.lit(0).cast("long").alias("place")), "none")
            break
        candidates = docs.join(lists, "doc_id").select("doc_id", "text", "repeated")
        rows = store(candidates.mapInArrow(_longer(lengths, level), "hash long, doc_id long, place long"), "longer")
        discard(lists)
        found = _repeated(rows)

    number = F.expr(f"place & {_NUMBER}")
    first = found.groupBy("hash").agg(F.min(F.struct("doc_id", number.alias("number"))).alias("first"))
    first = store(first.select("hash", F.col("first.doc_id").alias("first_doc"), F.col("first.number").alias("first_number")), "first")
    later = found.join(first, "hash").where((F.col("doc_id") != F.col("first_doc")) | (number != F.col("first_number"))).select("doc_id", "place")
    spans = store(later.union(whole).groupBy("doc_id").agg(F.collect_list("place").alias("found")), "spans")
    discard(found, first, whole)

    fields = [("doc_id", T.LongType()), ("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_sha256", T.StringType()), ("kept_text", T.StringType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    row = []
    if carry:
        docs = df.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"), row_struct(df, [c for c in df.columns if c not in (id_col, text_col)]))
        schema, row = schema.add("row", docs.schema["row"].dataType), ["row"]
    return docs.join(spans, "doc_id", "left").select("doc_id", "text", "found", *row).mapInArrow(_cut(length, schema.names), schema)

