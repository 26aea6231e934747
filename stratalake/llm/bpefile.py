"""Byte-level BPE files (tokenizers' JSON) and the pieces that their merges never cross."""

from __future__ import annotations

import json

import numpy as np

# The pattern and the byte alphabet of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class BpeFile:
    """Merges, vocabulary and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec["pre_tokenizer"], spec["model"]
        plain = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
        if not plain or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has special strings that take in their surroundings")
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in added}

    def token_bytes(self) -> dict[int, bytes]:
        """What each id decodes to."""
        of = {c: b for b, c in enumerate(byte_alphabet())}
        out = {i: bytes(of[c] for c in token) for token, i in self.vocab.items() if token not in self.special}
        return out | {i: s.encode() for s, i in self.special.items()}


LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 0, 1, 2, 3, 255


class Splitter:
    """Cuts text at the bounds of the pattern above, a whole string at a time.

    One pass over the characters' classes gives the bounds; a class is looked up once for each character.
    """

    def __init__(self):
        import regex

        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self.tests = [regex.compile(p).match for p in (r"\p{L}", r"\p{N}", r"\s")]

    def classes(self, codes: np.ndarray) -> np.ndarray:
        found = self.kinds[codes]
        for code in np.unique(codes[found == UNKNOWN]):
            self.kinds[code] = next((k for k, test in enumerate(self.tests) if test(chr(code))), OTHER)
        return self.kinds[codes]

    def bounds(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the text and the index of each piece's first one."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(codes)
        if not n:
            return codes, np.zeros(0, np.int64)
        kind = self.classes(codes)
        new = np.ones(n, bool)
        new[1:] = kind[1:] != kind[:-1]
        blank, space = codes == 32, kind == SPACE
        # The last of some white space goes with what follows it if it is a blank, else it is a piece of its own.
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:]
        new[last] = True
        joined = np.flatnonzero(last & blank) + 1
        new[joined] = False
        # A short form counts where a piece begins with its apostrophe; what is left of the word is a piece.
        for at in np.flatnonzero((codes == 39) & new).tolist():
            form = next((c for c in CONTRACTIONS if text.startswith(c, at)), None)
            if form:
                new[at + 1 : at + len(form)] = False
                if at + len(form) < n:
                    new[at + len(form)] = new[at + len(form)] or kind[at + len(form)] == LETTER
        return codes, np.flatnonzero(new)
