"""Runs of letters of many texts at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np

from stratalake.llm.wordhash import mix, range_hashes

POINTS = sys.maxunicode + 1


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is in a run (a word character but no decimal digit or underscore), whether it is a letter, and a hash."""
    points = [chr(p) for p in range(POINTS)]
    runs = np.array([c.isalnum() and not c.isdecimal() for c in points])
    letters = np.array([c.isalpha() for c in points])
    return runs, letters, mix(np.arange(1, POINTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class LetterRuns:
    """The lower-cased runs of some texts, in order: ``texts`` (the text of each), ``hashes``, and by text ``counts`` and ``has_letter``."""

    def __init__(self, texts: list[str]):
        runs, letters, values = _tables()
        lowered = [t.lower() for t in texts]
        joined = "".join(f"{t}\n" for t in lowered)
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])]).astype(np.int64)
        inside = np.concatenate([[False], runs[self.codes]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]  # every text ends with a line feed, which is in no run
        self.texts = np.searchsorted(bounds, self.starts, "right") - 1
        self.counts = np.bincount(self.texts, minlength=len(texts))
        upto = np.concatenate([[0], np.cumsum(letters[self.codes])])
        self.has_letter = upto[bounds[1:]] > upto[bounds[:-1]]
        self.hashes = range_hashes(values[self.codes], self.starts, self.ends)

    def words(self, which: np.ndarray) -> list[str]:
        """The runs of these numbers as text."""
        return [self.codes[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]

    def grids(self, which: np.ndarray, cells: int, most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Those runs by length: their places in ``which``, and their code points, a row each; about ``cells`` points at a time."""
        starts, sizes = self.starts[which], (self.ends - self.starts)[which]
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            size = int(sizes[order[a]])
            step = max(1, min(most, cells // (size + 2)))
            for low in range(a, b, step):
                some = order[low : min(low + step, b)]
                yield some, self.codes[starts[some, None] + np.arange(size)]
