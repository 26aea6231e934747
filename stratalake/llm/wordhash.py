"""Words of Arrow text columns and their 64-bit hashes, a whole batch at a time with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"

#: Characters worked on at once; a single longer text is taken whole.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Another hash of the same numbers for every salt."""
    return mix(x + np.uint64(salt * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(max(n, 1), base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each pair of bounds, from one running polynomial sum."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _powers(_INVERSE, n + 1)[starts]
    return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


#: Bytes of an Arrow batch. Spark's own bound is made for rows of numbers; texts are held several times over while a batch is worked on.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df):
    """The frame, with the session's Arrow batches bounded to ``BATCH_BYTES`` (a smaller bound stays as it is).

    The bound stays set, as the frame is run later.
    """
    conf = df.sparkSession.conf
    now = conf.get(_BATCH_SETTING).lower()
    units = {"b": 0, "k": 10, "m": 20, "g": 30}
    now = int(now.rstrip("bkmg")) << units.get(now.strip("0123456789")[:1], 0)
    if now <= 0 or now > BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the bounds of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    data = data[bounds[0] : bounds[-1]]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return data, bounds - bounds[0]


def slices(column: pa.Array, size: int = SLICE_BYTES):
    """Row ranges of about ``size`` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(lengths)
    at, n = 0, len(lengths)
    while at < n:
        until = total[at] - lengths[at] + size
        end = max(at + 1, int(np.searchsorted(total, until, "right")))
        yield at, end
        at = end


class Words:
    """Words of some texts: byte bounds ``starts`` and ``ends``, and ``first`` (word index by text, one more at the end)."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.bounds = text_bytes(column, lower)
        d = self.data
        word = ~((d == 32) | ((d >= 9) & (d <= 13)))
        filled = self.bounds[1:] > self.bounds[:-1]
        before = np.empty_like(word)
        before[1:], before[:1] = word[:-1], False
        before[self.bounds[:-1][filled]] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.empty_like(word)
        after[:-1], after[-1:] = word[1:], False
        after[self.bounds[1:][filled] - 1] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at, n = 0, len(out)
        while at < n:
            low = self.starts[at]
            end = max(at + 1, int(np.searchsorted(self.ends, low + SLICE_BYTES, "right")))
            values = table[self.data[low : self.ends[end - 1]]]
            out[at:end] = range_hashes(values, self.starts[at:end] - low, self.ends[at:end] - low)
            at = end
        return out

    def windows(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of ``length`` words inside one text."""
        starts = np.arange(len(hashes))
        starts = starts[starts + length <= self.first[1:][self.texts()]]
        return starts, range_hashes(hashes, starts, starts + length)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.astype(np.uint64, copy=False).view(np.int64)
