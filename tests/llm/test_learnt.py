import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpus import corpus, frame, result
from pyspark.sql import functions as F

from stratalake.llm import ann, language, toxicity
from stratalake.llm.letters import LetterRuns

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word, pieces):
    """All ways to cut a word into pieces; a single character may be none."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in pieces or n == 1:
            for rest in segmentations(word[n:], pieces):
                yield (word[:n], *rest)


def test_forward_pass_sums_all_segmentations():
    rng = random.Random(1)
    pieces = sorted({language.START + "a", language.START + "ab", language.START, "a", "b", "ab", "ba", "bab", "aba"})
    chances = np.array([[rng.random(), rng.random()] for _ in pieces] + [[1e-3, 1e-3]])
    lattice = language.Lattice(pieces)
    for word in ["a", "ab", "abab", "bbaabab", "abcab", "ccc"]:
        expected = np.zeros(2)
        counts = np.zeros((len(pieces), 2))
        for cut in segmentations(language.START + word, set(pieces)):
            p = np.prod([chances[pieces.index(x)] if x in pieces else chances[-1] for x in cut], axis=0)
            expected += p
            for x in cut:
                if x in pieces:
                    counts[pieces.index(x)] += p
        assert lattice.forward([word, word], chances)[2][0] == pytest.approx(np.log(expected))
        assert lattice.expected([word], np.array([[2.0, 3.0]]), chances) == pytest.approx(counts / expected * [2, 3])


def test_long_words_do_not_underflow():
    lattice = language.Lattice(["a", "aa"])
    chances = np.array([[1e-5], [1e-6], [1e-8]])
    short, long = (lattice.forward(["a" * n], chances)[2][0, 0] for n in (100, 2000))
    assert math.isfinite(long) and long == pytest.approx(20 * short, rel=0.05)


def test_long_words_are_learnt_whole(monkeypatch):
    """Scaled passes give what unscaled ones give, and the steps made again what kept ones give; nothing is cut."""
    rng = random.Random(3)
    pieces = sorted({language.START, language.START + "a", "a", "b", "ab", "abb", "ba"})
    chances = np.array([[rng.random() / 3, rng.random() / 3] for _ in pieces] + [[1e-3, 1e-3]])
    lattice = language.Lattice(pieces)
    words = ["".join(rng.choice("ab") for _ in range(150)) for _ in range(3)]
    counts = np.array([[1.0, 2.0], [3.0, 0.0], [0.5, 0.5]])
    scaled = lattice.expected(words, counts, chances)
    monkeypatch.setattr(language, "UNSCALED", 10_000)
    plain = lattice.expected(words, counts, chances)
    monkeypatch.setattr(language, "KEPT_STEPS", 10_000)
    assert scaled == pytest.approx(plain) and lattice.expected(words, counts, chances) == pytest.approx(plain)
    monkeypatch.undo()
    lengths = np.array([len(p) for p in pieces])
    assert (plain * lengths[:, None]).sum(axis=0) == pytest.approx(counts.sum(axis=0) * 151)  # every letter and start is in a piece
    alone = lattice.expected(["a" * 3000], np.array([[1.0, 1.0]]), chances)
    assert np.isfinite(alone).all() and alone[pieces.index("a")] == pytest.approx([2999, 2999], abs=1.01)


def test_letter_runs_are_those_of_the_pattern():
    pattern = re.compile(r"[^\W\d_]+")
    texts = ["Hello wörld 12ab_c İX", "", "²½ 5", "a" * 300 + "\n\nZ", "été Ⅻ ₂ 漢字かな 😀x", "no_under score"]
    runs = LetterRuns(texts)
    words = runs.words(np.arange(len(runs.starts)))
    assert [[w for w, t in zip(words, runs.texts) if t == i] for i in range(len(texts))] == [pattern.findall(t.lower()) for t in texts]
    assert runs.counts.tolist() == [len(pattern.findall(t.lower())) for t in texts]
    assert runs.has_letter.tolist() == [any(map(str.isalpha, t)) for t in texts]
    assert len(set(runs.hashes.tolist())) == len(set(words))
    assert LetterRuns([]).counts.tolist() == []


def test_languages_of_a_table(spark):
    rows = corpus(seed=4, n=120)
    got = {}
    found = language.identify_languages(frame(spark, rows), PIECES, carry=True)
    for r in found.select("doc_id", "held_out", "lang_pred", "score", "row.text").collect():
        got[r[0], r[4]] = r[1:4]
    assert found.count() == len(rows)
    right = []
    for i, text, lang, _ in rows:
        held, pred, score = got[i, text]
        assert held == (zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2)
        if not any(c.isalpha() for c in text or ""):
            assert (pred, score) == ("und", 0.0)
        else:
            assert pred in ("en", "de", "fr") and 0 < score <= 1
            if held and lang and len(text.split()) >= 10 and len(text) < 20_000:
                right.append(pred == lang)
    assert len(right) > 10 and np.mean(right) >= 0.9


def test_language_sees_neither_label_nor_id(spark):
    rows = [(i, t, lang, s) for i, t, lang, s in corpus(seed=4, n=60)]
    held = [(i, t, None if i is not None and zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    a, b = (result(language.identify_languages(frame(spark, r), PIECES), "doc_id", "lang_pred", "score") for r in (rows, held))
    assert a == b


def test_no_language_to_learn_from(spark):
    rows = [(1, "some words", None, None), (2, None, "en", None)]
    assert result(language.identify_languages(frame(spark, rows), PIECES), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]
    assert result(language.identify_languages(frame(spark, []), PIECES), "doc_id") == []


def test_held_out_languages_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify_languages(docs, PIECES).where("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def plain_segments(scores):
    """The best stretch, then the same to its left and right."""
    best, at = 0.0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if (s := sum(scores[i:j])) > best + 1e-12:
                best, at = s, (i, j)
    if at is None:
        return []
    left, right = plain_segments(scores[: at[0]]), plain_segments(scores[at[1] :])
    return left + [(at[0], at[1] - 1, best)] + [(a + at[1], b + at[1], s) for a, b, s in right]


def test_segments_are_all_maximal_ones():
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randint(0, 14)
        gains = {i: rng.random() * 3 for i in range(n) if rng.random() < 0.4}
        drift = rng.choice([0.1, 0.5, 1.0]) + rng.random() * 0.01
        got = toxicity.maximal_segments(list(gains), list(gains.values()), drift)
        expected = plain_segments([gains.get(i, -drift) for i in range(n)])
        assert [g[:2] for g in got] == [e[:2] for e in expected]
        assert [g[2] for g in got] == pytest.approx([e[2] for e in expected])


def test_decay_solves_its_equation():
    rate = toxicity.decay(np.array([2.0, 0.5]), np.array([3.0, 40.0]), 10_000.0)
    p = np.array([3, 40]) / 10_000
    assert (p * np.exp(rate * np.array([2.0, 0.5]))).sum() + (1 - p.sum()) * math.exp(-rate * toxicity.DRIFT) == pytest.approx(1)


def test_a_word_has_the_gain_of_its_longest_token():
    model = toxicity.Model({"grob-": 1.0, "grobia-": 2.0, "grobe": 3.0})
    assert [model.gain(w) for w in ("grob", "groben", "grobian", "grobe", "lieb")] == [0.0, 1.0, 2.0, 3.0, 0.0]


def toxic_rows():
    """Texts over a few thousand words, some with insults; a null, an empty and a long text among them."""
    rng = random.Random(8)
    words = ["".join(rng.choices(["ba", "no", "ri", "ta", "lu", "me", "si", "ko"], k=rng.randint(1, 5))) for _ in range(3000)]
    rows, labels = [], []
    for i in range(300):
        text = rng.choices(words, k=rng.choice([3, 30, 100, 200, 400]))
        bad = i % 6 == 0
        for _ in range(4 * bad):
            text.insert(rng.randint(0, len(text)), rng.choice(["grobian", "Lump!", "schuft", "schufte"]))
        rows.append((i, " ".join(text), "en", "s0"))
        labels.append((i, int(bad)))
    rows[1], rows[2], rows[7] = (1, None, "en", "s0"), (2, "", "en", "s0"), (7, " ".join(rng.choices(words, k=30_000)), "en", "s0")
    return rows, labels


def test_toxicity_of_a_table(spark):
    rows, labels = toxic_rows()
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (4, 0), (4, 0)], "doc_id long, toxic int")
    extra = [(None, None, None, None), (None, "schuft", None, None), rows[0]]
    got = toxicity.score_toxicity(frame(spark, rows + extra), known)
    out = got.select("doc_id", "held_out", "score", "predicted", F.size("segments").alias("n")).collect()
    assert len(out) == len(rows) + 3
    held = [r for r in out if r["held_out"]]
    truth = dict(labels)
    assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    wrong = [r for r in held if r["doc_id"] is not None and r["predicted"] != truth[r["doc_id"]]]
    assert len(held) > 50 and not wrong


def test_toxicity_without_both_labels(spark):
    rows, labels = toxic_rows()
    for known, most in (([], 0), ([(i, 0) for i, _ in labels], 0), ([(i, 1) for i, _ in labels], 1)):
        df = spark.createDataFrame(known, "doc_id long, toxic int")
        assert {r[0] for r in result(toxicity.score_toxicity(frame(spark, rows[:40]), df), "predicted")} == {most}
    assert result(toxicity.score_toxicity(frame(spark, []), spark.createDataFrame(labels, "doc_id long, toxic int")), "doc_id") == []


def test_held_out_toxicity_of_the_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id")
    hits = {(r[0], r[1]): r[2] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert hits[1, 1] / (hits[1, 1] + hits.get((1, 0), 0)) > 0.8
    assert hits.get((0, 1), 0) / hits[0, 0] < 0.01


def brute(vectors, queries, k):
    out = []
    for qi, q in queries:
        near = sorted((-float(np.dot(q, v)), i) for i, v in vectors if i != qi)[:k]
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    return out


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.round(rng.normal(size=6), 2)]) for i in range(n)]


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit("x") for c in ("id", "vector", "part", "v", "q", "key", "copy", "rank", "score", "label")})


def test_few_vectors_are_searched_exactly(spark):
    rows = vectors(130)
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # many equal ones: ties go to the smaller id
    odd = [(2000, None), (2020, []), (2040, [0.0] * 6), (2060, [1.0, float("nan")] + [0.0] * 4), (2080, [1.0, None] + [0.0] * 4), (2100, [float("inf")] * 6), (2120, [1.0] * 5), (None, [9.0] * 6)]
    got = ann.nearest(table(spark, rows + odd + [rows[5]]), every=20, k=7).collect()
    exact = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    expected = brute(exact, [(i, v) for i, v in exact if i % 20 == 0], 7)
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(e[:3] for e in expected)
    assert [r[3] for r in sorted(got)] == pytest.approx([e[3] for e in sorted(expected)])


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = vectors(200)
    whole = sorted(map(tuple, ann.nearest(table(spark, rows), every=2, k=5).collect()))
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 30)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 20)
    assert sorted(map(tuple, ann.nearest(table(spark, rows), every=2, k=5).collect())) == whole


def test_fewer_candidates_and_empty_table(spark):
    assert len(ann.nearest(table(spark, vectors(4)), every=2, k=20).collect()) == 2 * 3
    assert ann.nearest(table(spark, vectors(1)), every=1, k=20).collect() == []
    assert ann.nearest(table(spark, []), every=1, k=20).collect() == []


def test_parts_are_balanced():
    x = np.random.default_rng(2).normal(size=(1000, 8))
    part = ann.balanced_parts(x, ann.neighbour_lists(x, 8), 10)
    assert np.bincount(part, minlength=10).max() <= math.ceil(100 * 1.05)


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = ann.nearest(df).collect()
    rows = df.select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    hits = total = 0
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        top = set(ids[np.argsort(-s)[:20]].tolist())
        hits += len(top & found[ids[i]])
        total += 20
    assert hits / total >= 0.9
