"""Parity sketches whose width follows the set's size, and the bound that two of them give."""

from __future__ import annotations

import numpy as np

from stratalake.llm.wordhash import salted, signed

#: 64-bit words of the narrowest sketch.
LEAST_WORDS = 16
#: Words of the sketch of fixed width, which is compared first.
FIXED_WORDS = 4
FIXED = [f"parity{i}" for i in range(FIXED_WORDS)]


def parity_words(sizes: np.ndarray, percent: int) -> np.ndarray:
    """64-bit words of the sketches: a power of two, with four bits or more for each element that similar sets may differ in."""
    bits = 4 * 2 * sizes * (100 - percent) // (100 + percent)
    need = np.maximum(LEAST_WORDS, -(-bits // 64))
    return np.left_shift(1, np.ceil(np.log2(need)).astype(np.int64))


def parity_sketches(texts: np.ndarray, grams: np.ndarray, sizes: np.ndarray, percent: int, salt: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and 64-bit words of each set's sketch: every element flips one bit, so two sketches differ in at most as many bits as the sets in elements."""
    words = parity_words(sizes, percent)
    bounds = np.concatenate([[0], np.cumsum(words)])
    bit = salted(grams, salt) & (64 * words[texts] - 1).astype(np.uint64)
    flips = np.bincount(64 * bounds[texts] + bit.astype(np.int64), minlength=64 * int(bounds[-1])) & 1
    return bounds.astype(np.int32), np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def fixed_sketches(texts: np.ndarray, grams: np.ndarray, rows: int, salt: int = 6) -> list[np.ndarray]:
    """Sketches of ``FIXED_WORDS`` words whatever the set's size, a column of Spark's longs for each word."""
    bits = 64 * FIXED_WORDS
    flips = np.bincount(bits * texts + (salted(grams, salt) & np.uint64(bits - 1)).astype(np.int64), minlength=bits * rows) & 1
    words = np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64).reshape(rows, FIXED_WORDS)
    return [signed(np.ascontiguousarray(words[:, i])) for i in range(FIXED_WORDS)]


def fixed_allow(a: str, b: str, most: str) -> str:
    """SQL: the fixed sketches, their columns ending in ``a`` and ``b``, differ in at most ``most`` bits."""
    return " + ".join(f"bit_count({c}{a} ^ {c}{b})" for c in FIXED) + f" <= {most}"


def most_difference(a: str, b: str, percent: int) -> str:
    """SQL: the most elements in which sets of ``a`` and ``b`` elements with ``percent`` % similarity differ."""
    return f"(({100 - percent} * ({a} + {b})) div {100 + percent})"


def sizes_allow(a: str, b: str, percent: int) -> str:
    """SQL: sets of ``a`` and ``b`` elements can have ``percent`` % similarity."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def sketches_allow(a: str, b: str, most: str) -> str:
    """SQL: sketches ``a`` and ``b`` differ in at most ``most`` bits; the wider one is folded, as a sketch of half the width is the XOR of both halves.

    Sketches of more than twice another's width are let through.
    """

    def fold(x: str, y: str) -> str:
        half = f"zip_with(slice({x}, 1, size({y})), slice({x}, size({y}) + 1, size({y})), (u, v) -> u ^ v)"
        return f"CASE WHEN size({x}) = 2 * size({y}) THEN {half} ELSE {x} END"

    bits = f"aggregate(zip_with({fold(a, b)}, {fold(b, a)}, (u, v) -> bit_count(u ^ v)), 0, (s, x) -> s + x)"
    return f"(size({a}) > 2 * size({b}) OR size({b}) > 2 * size({a}) OR {bits} <= {most})"
