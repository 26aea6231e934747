"""Language identification by unigram pieces, summed over all segmentations of a word."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.letters import LetterRuns
from stratalake.llm.rows import quoted, row_struct
from stratalake.llm.wordhash import bounded_batches, mix, slices
from stratalake.sources.scratch import discard, store

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"
#: Chance of a character that is no piece.
UNSEEN = 1e-8
CACHED = 150_000
#: Letters after which chances are scaled, before they get too small for a double.
UNSCALED = 24
#: Letters up to which the steps of a lattice are kept for the way back; beyond, they are made again.
KEPT_STEPS = 64
#: Letters of words of one length that are worked on together.
LATTICE_CELLS = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def read_pieces(path: str) -> list[str]:
    """The vocabulary of a sentencepiece file, as far as it is made of lower-case letters."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if (body := p.removeprefix(START)) == body.lower() and (not body or LETTERS.fullmatch(body))})


def _grid(words: list[str] | np.ndarray) -> np.ndarray:
    """Code points of words of one length, a row each; what is a grid already stays."""
    if isinstance(words, np.ndarray):
        return words
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


class Lattice:
    """All segmentations of words into pieces. Index ``size`` is a character that is no piece.

    Words are given as text or as rows of code points, all of one length.
    """

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)
        keys = np.array([self._keys(_grid([p]))(0, len(p))[0] for p in pieces], np.uint64)
        self.order = np.argsort(keys)
        self.keys = np.append(keys[self.order], np.uint64(0xFFFFFFFFFFFFFFFF))
        # By the first bits of a hash, so that few others are searched for: the pieces, and their beginnings.
        self.likely, self.begins = np.zeros(1 << 20, bool), np.zeros(1 << 20, bool)
        self.likely[keys >> np.uint64(44)] = True
        begins = list({p[:k] for p in pieces for k in range(1, len(p))})
        for some in grouped(begins):
            own = _grid([begins[i] for i in some])
            self.begins[self._keys(own)(0, own.shape[1]) >> np.uint64(44)] = True

    @staticmethod
    def _keys(codes: np.ndarray):
        """A function of two places and some words: the hash of what stands between the places in each."""
        n = codes.shape[1]
        powers, inverse = (np.multiply.accumulate(np.append(np.uint64(1), np.full(n, b, np.uint64))) for b in (_BASE, _INVERSE))
        sums = np.zeros((n + 1, len(codes)), np.uint64)
        np.cumsum((mix(codes) * powers[:n]).T, axis=0, out=sums[1:])
        return lambda start, end, rows=slice(None): mix((sums[end, rows] - sums[start, rows]) * inverse[start] + np.uint64(end - start))

    def steps(self, words: list[str] | np.ndarray, backward: bool = False):
        """(start, end, words, piece index by word) of every possible step through words of one length, starts ascending or descending.

        A start's words are followed only as long as what stands behind it begins a piece.
        """
        codes = _grid(words)
        codes = np.concatenate([np.full((len(codes), 1), ord(START), np.uint32), codes], axis=1)
        keys, n = self._keys(codes), codes.shape[1]
        for start in reversed(range(n)) if backward else range(n):
            alive = np.arange(len(codes))
            for end in range(start + 1, min(n, start + self.longest) + 1):
                key = keys(start, end, alive)
                first = key >> np.uint64(44)
                rows = np.flatnonzero(self.likely[first])
                at = np.searchsorted(self.keys[:-1], key[rows])
                hit = self.keys[at] == key[rows]
                rows, piece = alive[rows[hit]], self.order[at[hit]]
                if end - start == 1:
                    every = np.full(len(codes), self.size)
                    every[rows] = piece
                    yield start, end, slice(None), every
                elif len(rows):
                    yield start, end, rows, piece
                alive = alive[self.begins[first]]
                if not len(alive):
                    break

    def forward(self, words: list[str] | np.ndarray, chances: np.ndarray, steps=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled chances of the words' beginnings by length, word and language, the logs of what they were divided by, and the log of the whole words' chances."""
        n, k = _grid(words).shape[1] + 1, chances.shape[1]
        alpha, logs = np.zeros((n + 1, len(words), k)), np.zeros((n + 1, len(words), k))
        alpha[0] = 1
        scaled, log = 0, np.zeros((len(words), k))
        for start, end, rows, piece in self.steps(words) if steps is None else steps:
            if start - scaled > UNSCALED:  # before numbers get too small
                high = start + self.longest + 1  # what is behind the start has been begun
                top = np.maximum(alpha[start:high].max(axis=0), 1e-300)
                logs[scaled:start] = log
                alpha[start:high] /= top
                log, scaled = log + np.log(top), start
            alpha[end, rows] += alpha[start, rows] * chances[piece]
        logs[scaled:] = log
        return alpha, logs, log + np.log(np.maximum(alpha[n], 1e-300))

    def expected(self, words: list[str] | np.ndarray, counts: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each taken ``counts`` times by language."""
        n, k = _grid(words).shape[1] + 1, counts.shape[1]
        steps = list(self.steps(words)) if n <= KEPT_STEPS else None
        alpha, logs, whole = self.forward(words, chances, steps)
        beta, log, scaled = np.zeros_like(alpha), np.zeros((len(words), k)), n
        beta[n] = 1
        out = np.zeros((self.size + 1) * k)
        weight = at = None
        for start, end, rows, piece in self.steps(words, backward=True) if steps is None else sorted(steps, key=lambda s: -s[0]):
            if scaled - start > UNSCALED:
                high = start + self.longest + 1
                top = np.maximum(beta[start + 1 : high].max(axis=0), 1e-300)
                beta[start + 1 : high] /= top
                log, scaled = log + np.log(top), start
            if at != start:
                at, weight = start, alpha[start] * counts * np.exp(np.minimum(logs[start] + log - whole, 700))
            after = beta[end, rows] * chances[piece]
            np.add.at(out, (piece[:, None] * k + np.arange(k)).ravel(), (after * weight[rows]).ravel())
            beta[start, rows] += after
        return out.reshape(-1, k)[: self.size]


def grouped(words: list[str]) -> list[list[int]]:
    """Places of words of one length, as many at a time as keep the lattice small."""
    lengths: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        lengths.setdefault(len(w), []).append(i)
    out = []
    for length, places in lengths.items():
        most = max(1, min(4096, LATTICE_CELLS // (length + 2)))
        out += [places[i : i + most] for i in range(0, len(places), most)]
    return out


def _word_counts(batches):
    """Letter runs of training texts and how often they occur, by language; added up over batches while there is room."""
    found: dict[str, Counter] = {}

    def rows():
        for lang, words in found.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(words), "word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})
        found.clear()

    for batch in batches:
        for low, high in slices(batch.column(1)):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).slice(low, high - low).to_pylist(), batch.column(1).slice(low, high - low).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text or "")
            for lang, texts in by_lang.items():
                runs = LetterRuns(texts)
                _, first, times = np.unique(runs.hashes, return_index=True, return_counts=True)
                own = found.setdefault(lang, Counter())
                for word, n in zip(runs.words(first), times.tolist(), strict=True):
                    own[word] += n
            if sum(map(len, found.values())) > CACHED:
                yield from rows()
    yield from rows()


def _expectations(pieces: list[str], langs: list[str], chances: np.ndarray):
    place = {lang: i for i, lang in enumerate(langs)}

    def expectations(batches):
        lattice = Lattice(pieces)
        total = np.zeros((lattice.size, len(langs)))
        for batch in batches:
            words: dict[str, np.ndarray] = {}
            for lang, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words.setdefault(word, np.zeros(len(langs)))[place[lang]] += n
            names = list(words)
            for some in grouped(names):
                own = [names[j] for j in some]
                total += lattice.expected(own, np.stack([words[w] for w in own]), chances)
        at, lang = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(at.astype(np.int32)), "lang": pa.array(lang.astype(np.int32)), "n": pa.array(total[at, lang])})

    return expectations


def learn(labelled: DataFrame, pieces: list[str], rounds: int = 2, smoothing: float = 0.05) -> tuple[list[str], np.ndarray]:
    """Languages and each piece's chance in them, from rows ``lang, text``, by expectation maximisation over word counts.

    Words are counted in Spark with what a batch holds in common added up first. Each round is one pass over distinct words; what it
    returns is one number per piece and language, whatever the size of the corpus.
    """
    words = labelled.select("lang", "text").mapInArrow(_word_counts, "lang string, word string, n long")
    words = store(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    size = len(pieces)
    chances = np.full((size + 1, len(langs)), 1.0 / max(1, size))
    chances[size] = UNSEEN
    for _ in range(rounds if langs else 0):
        sums = words.mapInArrow(_expectations(pieces, langs, chances), "piece int, lang int, n double")
        counts = np.full((size, len(langs)), smoothing)
        for r in sums.groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
            counts[r["piece"], r["lang"]] += r["n"]
        chances[:size] = counts / counts.sum(axis=0)
    discard(words)
    return langs, chances


def _predict(pieces: list[str], langs: list[str], chances: np.ndarray, names: tuple[str, str] | None = None):
    """``names`` are those of id and text within a struct ``row``, which is passed on, where the rows are carried along."""

    def predict(batches):
        lattice = Lattice(pieces)
        known: dict[int, int] = {}  # of a word's hash, its row of the table
        table = np.zeros((1 << 12, len(langs)))
        for batch in batches:
            flags, rows = batch.column(0), batch.column(1)
            batch = pa.RecordBatch.from_arrays([flags, *([rows.field(n) for n in names] if names else batch.columns[1:])], names=["held_out", "doc_id", "text"])
            for low, high in slices(batch.column(2)):
                part = batch.slice(low, high - low)
                runs = LetterRuns([t or "" for t in part.column(2).to_pylist()])
                counts = np.where(runs.has_letter, runs.counts, 0)
                hashes, first, inverse = np.unique(runs.hashes, return_index=True, return_inverse=True)
                if len(known) + len(hashes) > CACHED:
                    known.clear()
                at = [known.get(h, -1) for h in hashes.tolist()]
                at = np.array(at, np.int64)
                missing = np.flatnonzero(at < 0)
                at[missing] = len(known) + np.arange(len(missing))
                while len(known) + len(missing) > len(table):
                    table = np.concatenate([table, np.zeros_like(table)])
                for some, codes in runs.grids(first[missing], LATTICE_CELLS):
                    table[at[missing[some]]] = lattice.forward(codes, chances)[2]
                known.update(zip(hashes[missing].tolist(), at[missing].tolist(), strict=True))
                word_logs = table[at][inverse]
                logs = [np.bincount(runs.texts, weights=word_logs[:, i], minlength=len(part)) for i in range(len(langs))]
                logs = np.stack(logs, axis=1) if langs else np.zeros((len(part), 0))
                found, scores = [], []
                for n, row in zip(counts.tolist(), logs, strict=True):
                    if not n or not langs:
                        found.append("und")
                        scores.append(0.0)
                        continue
                    best = int(row.argmax())
                    found.append(langs[best])
                    scores.append(float(1 / np.exp(row - row[best]).sum()))
                out = [part.column(1), part.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
                more = [rows.slice(low, high - low)] if names else []
                yield pa.RecordBatch.from_arrays(out + more, names=["doc_id", "held_out", "lang_pred", "score", "row"][: len(out + more)])

    return predict


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves the remainder ``part``; a row without id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def identify_languages(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, part: int = 2, carry: bool = False
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: each text's language and how sure that is (0 to 1).

    Learnt from the languages given for rows that are not held out; predictions see the text alone. A text is its runs of
    letters, lower-cased. Each run's chance in a language is the sum over all ways to cut it into pieces of the
    sentencepiece vocabulary at ``path``, found by a forward pass; a text's is the product. The score is the chance of the best
    language if all are equally likely beforehand.

    A null text or one without letters is ``und`` with score 0, and so is any text if no language could be learnt. Ties go to
    the language that sorts first. With ``carry`` a column ``row`` holds the input row. Null languages are not learnt from. Repeated rows are judged alike. An empty table gives no rows.
    """
    pieces = read_pieces(path)
    rows, doc_id, text = bounded_batches(df), quoted(id_col), quoted(text_col)
    known = rows.where(~held_out(doc_id, parts, part)).select(quoted(lang_col).alias("lang"), text.alias("text"))
    langs, chances = learn(known.where("lang IS NOT NULL AND text IS NOT NULL"), pieces)
    columns = [row_struct(df)] if carry else [doc_id.alias("doc_id"), text.alias("text")]
    docs = rows.select(held_out(doc_id, parts, part).alias("held_out"), *columns)
    fields = [("doc_id", df.schema[id_col].dataType), ("held_out", T.BooleanType()), ("lang_pred", T.StringType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField(*f) for f in fields] + ([docs.schema["row"]] if carry else []))
    return docs.mapInArrow(_predict(pieces, langs, chances, (id_col, text_col) if carry else None), schema)
