"""Byte-level BPE encoding and decoding; long texts are encoded in halves and joined."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.bpefile import PATTERN, BpeFile
from stratalake.llm.wordhash import bounded_batches, slices

LEAF_CHARS = 16_384
FIRST_WINDOW = 8

#: Letters that every version of Unicode in use calls letters, and characters that none calls white space.
_PLAIN_LETTER_BELOW = 0x250


class Encoder:
    """Encoding of whole strings, and of long ones as a tree of halves."""

    def __init__(self, bpe: BpeFile):
        import tiktoken

        ids = [bpe.vocab[a + b] for a, b in bpe.merges]
        if ids != sorted(ids):
            raise ValueError("ids don't follow the order of the merges")
        self.bytes_of = bpe.token_bytes()
        ranks = {b: i for i, b in self.bytes_of.items() if i not in bpe.special.values()}
        self.plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=bpe.special)
        self.special = bpe.special
        self.widths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.widths[i] = len(b)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode(text, allowed_special="all"), np.int32)

    def tree(self, text: str, leaf: int) -> np.ndarray:
        """Ids of a text from those of its halves, and so on down to ``leaf`` characters."""
        if len(text) <= max(leaf, 1):
            return self.encode(text)
        middle = len(text) // 2
        return self.join([text[:middle], text[middle:]], [self.tree(text[:middle], leaf), self.tree(text[middle:], leaf)])

    def join_all(self, texts: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """Ids of the concatenated texts: neighbours are joined pairwise, level by level."""
        while len(texts) > 1:
            pairs = range(0, len(texts) - 1, 2)
            odd = len(texts) % 2
            ids = [self.join(texts[i : i + 2], ids[i : i + 2]) for i in pairs] + ids[len(ids) - odd :] * odd
            texts = [texts[i] + texts[i + 1] for i in pairs] + texts[len(texts) - odd :] * odd
        return ids[0] if ids else np.zeros(0, np.int32)

    def join(self, texts: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """Ids of left + right from the ids of both.

        A window of tokens around the join is encoded anew and grown until it agrees with both sides at its ends.
        An end agrees

        * at the text's end, or where white space follows another character: no piece of the pattern crosses that; or
        * inside a run of letters, if the window's token there is also the side's token there. The pieces
          are then the same, and within a piece a token sequence is the encoding if each adjacent pair is one;
          every pair is one of the left side, of the window or of the right side.
        """
        left, right = (t.encode() for t in texts)
        a, b = ids
        if not len(a) or not len(b):
            return np.concatenate([a, b])
        whole, middle = left + right, len(left)
        a_ends, b_ends = np.cumsum(self.widths[a]), middle + np.cumsum(self.widths[b])
        size = FIRST_WINDOW
        while True:
            i, j = max(0, len(a) - size), min(len(b), size)
            while i > 0 and not self._opens(whole, int(a_ends[i - 1])):
                i -= 1
            while j < len(b) and not self._opens(whole, int(b_ends[j - 1])):
                j += 1
            low, high = int(a_ends[i - 1]) if i else 0, int(b_ends[j - 1]) if j else middle
            window = self.encode(whole[low:high].decode())
            if (self._splits(whole, low) or self._in_letters(whole, low) and window[0] == a[i]) and (
                self._splits(whole, high) or self._in_letters(whole, high) and window[-1] == b[j - 1]
            ):
                return np.concatenate([a[:i], window, b[j:]])
            size *= 2

    @staticmethod
    def _opens(whole: bytes, at: int) -> bool:
        """Whether a character starts here."""
        return whole[at] & 0xC0 != 0x80

    @staticmethod
    def _splits(whole: bytes, at: int) -> bool:
        """Whether pieces always end here: at an end, or with a blank or line break after a printable ASCII character."""
        return at in (0, len(whole)) or whole[at] in b" \n" and 32 < whole[at - 1] < 127

    @staticmethod
    def _in_letters(whole: bytes, at: int) -> bool:
        """Whether four letters stand before and one after, so that no short form reaches over this place."""
        near = whole[max(0, at - 8) : at].decode(errors="ignore")[-4:] + whole[at : at + 4].decode(errors="ignore")[:1]
        return len(near) == 5 and all(c.isalpha() and ord(c) < _PLAIN_LETTER_BELOW for c in near)

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode(errors="replace")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([*parts, np.zeros(0, np.int32)]).astype(np.int32)))


def _encode(path: str, keep: list[int], names: list[str], text: int):
    def encode(batches):
        encoder = Encoder(BpeFile(path))
        for batch in batches:
            for low, high in slices(batch.column(text)):
                part = batch.slice(low, high - low)
                ids = [encoder.encode(t or "") for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keep], _lists(ids)], names=names)

    return encode


def _cut(leaf: int):
    def cut(batches):
        for batch in batches:
            for doc_id, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = -(-len(text) // leaf)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([doc_id] * n, batch.schema.field(0).type),
                        "mark": pa.array([mark] * n, pa.int64()),
                        "place": pa.array(range(n), pa.int32()),
                        "piece": pa.array([text[i * leaf : (i + 1) * leaf] for i in range(n)], pa.string()),
                    }
                )

    return cut


def _join(path: str):
    held = []  # one encoder for all documents of a task

    def join(table: pa.Table) -> pa.Table:
        if not held:
            held.append(Encoder(BpeFile(path)))
        encoder = held[0]
        table = table.sort_by("place")
        places = table.column("place").to_pylist()
        copies = places.count(0)
        texts, ids = table.column("piece").to_pylist()[::copies], table.column("ids").to_pylist()[::copies]
        whole = encoder.join_all(texts, [np.array(x, np.int32) for x in ids])
        return pa.table({"doc_id": table.column("doc_id").combine_chunks()[:1].take(pa.array([0] * copies)), "ids": _lists([whole] * copies)})

    return join


def encode(df: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every text: its token ids by the byte-level BPE file at ``path``, special strings included.

    Texts of up to ``leaf_chars`` characters are encoded where they are read. Longer ones are cut into so long
    pieces wherever that falls, the pieces are spread over the cluster and encoded in parallel, and then joined in a tree: around
    each join a growing window is encoded anew until it agrees with both sides (:meth:`Encoder.join`), which gives exactly the
    ids of the whole text. Only a document's own pieces come together in one task.

    A null text counts as empty and has no ids. Repeated rows, also of long texts, come out as often as they went in. The file must be
    there on every executor.
    """
    docs = bounded_batches(df).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    short = docs.where(F.length("text") <= leaf_chars).mapInArrow(_encode(path, [0], ["doc_id", "ids"], 1), f"doc_id {kind}, ids array<int>")
    long = docs.where(F.length("text") > leaf_chars).select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), "text")
    pieces = long.mapInArrow(_cut(leaf_chars), f"doc_id {kind}, mark long, place int, piece string").repartition("mark", "place")
    names = ["doc_id", "mark", "place", "piece", "ids"]
    coded = pieces.mapInArrow(_encode(path, [0, 1, 2, 3], names, 3), f"doc_id {kind}, mark long, place int, piece string, ids array<int>")
    return short.union(coded.groupBy("mark", "doc_id").applyInArrow(_join(path), f"doc_id {kind}, ids array<int>"))


def _decode(path: str, keep: int):
    def decode(batches):
        encoder = Encoder(BpeFile(path))
        for batch in batches:
            lists = batch.column(keep)
            values, bounds = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            texts = [encoder.decode(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return decode


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """The rows with a column ``decoded``: the text of the ids, invalid UTF-8 replaced. A null list gives an empty text."""
    rows = bounded_batches(df).drop("decoded")
    rows = rows.withColumn(ids_col, F.coalesce(ids_col, F.expr("cast(array() as array<int>)")))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(_decode(path, rows.columns.index(ids_col)), f"{schema}, decoded string")


def digests(df: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of rows with ``ids`` and ``decoded``."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
