"""Periodic runs, the filter audit and MinHash near-dedup against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from corpus import corpus, frame, result
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_jaccard_repeats import plain_groups, shingles

from stratalake.llm import audit, minhash, parity, runs
from stratalake.llm.wordhash import salted

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, exponent=4, shortest=6):
    """Every stretch of equal words q apart, for every q, that has no smaller period."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(shortest, exponent * q) and not any(all(w[t] == w[t + p] for t in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(0, 59), st.integers(1, 12), st.integers(0, 80))
def test_runs_are_those_of_all_periods(words, a, p, more):
    words = words[: a + p] + [words[a + i % p] for i in range(more) if a + i % p < len(words)]
    assert runs.periodic_runs(np.array(words, np.int64), len(words)) == plain_runs(words)


def test_runs_of_nested_and_very_long_sequences():
    nested = [0]
    while len(nested) < 3000:
        nested = nested * 5 + [len(nested)]
    assert runs.periodic_runs(np.array(nested[:700]), 700) == plain_runs(nested[:700])
    assert runs.periodic_runs(np.array([1, 2, 3] * 100_000), 300_000) == [(0, 300_000, 3)]
    assert runs.periodic_runs(np.zeros(0, np.int64), 0) == []
    with pytest.raises(ValueError):
        runs.periodic_runs(np.zeros(3, np.int64), 3, exponent=2)


def plain_document_runs(i, text, rewrite):
    w = WORDS.findall(text or "")
    if rewrite and i is not None:
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(len(w))]
    found = plain_runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {j for s, n, q in found for j in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for j, x in enumerate(w) if j not in gone)
    return (i, len(found), *best, 1000 * best[1] // best[2] if found else None, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("rewrite", [None, runs.planted])
def test_document_runs(spark, rewrite):
    rows = [r for r in corpus() if len(r[1] or "") < 60_000]  # the plain version takes too long for these
    rows += [(600 + i, "a b c " * i + "x " * (i % 9) + "tail", "en", "s0") for i in range(40)]
    got = runs.find_runs(frame(spark, rows).repartition(3), rewrite=rewrite)
    assert result(got, *RUN_COLUMNS) == sorted((plain_document_runs(i, t, rewrite) for i, t, *_ in rows), key=repr)
    assert result(runs.find_runs(frame(spark, [])), "doc_id") == []


def test_kept_words_are_joined_over_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(runs, "JOINED_WORDS", 7)
    from stratalake.llm.wordhash import Words
    import pyarrow as pa

    texts = ["a bb  ccc", "", None, "d", " ".join(f"w{i}" for i in range(30)), "é ü\tß"]
    words = Words(pa.array(texts))
    got = runs.joined_digests(words, np.arange(len(words.starts)), words.first)
    assert got == [hashlib.sha256(" ".join(WORDS.findall(t or "")).encode()).hexdigest() for t in texts]


def plain_failures(rows):
    out = []
    for i, text, lang, _ in rows:
        t = text or ""
        w = WORDS.findall(t)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t))]
        fails.append(i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows))
        out.append((i, lang or "", fails))
    return out


def plain_audit(rows, labels):
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    facts = plain_failures(rows)
    out = []
    for part in {p for _, p, _ in facts}:
        own = [(f, i in good and i is not None, i in toxic and i is not None) for i, p, f in facts if p == part]
        total, lines = dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            alive = own
            for k, x in enumerate(order):
                at = "ABCDE".index(x)
                removed = [r for r in alive if r[0][at]]
                alive = [r for r in alive if not r[0][at]]
                failing = [r for r in own if r[0][at]]
                total[x] += len(removed)
                counts = [len(alive), len(removed), len(failing) - len(removed), sum(sum(r[0]) == 1 for r in failing), sum(r[1] for r in removed), sum(r[2] for r in removed)]
                lines.append((part, "".join(order), k + 1, *counts, x))
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out, key=repr)


AUDIT_COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_is_that_of_filters_applied_one_by_one(spark):
    rows = corpus() + [(700, "LOUD TEXT 50 % off", "en", "s0"), (701, "LOUD TEXT 50 % off", "de", "s0"), (702, "½" * 40, None, None), (703, "Ab " * 200, "en", None)]
    labels = [(r[0], k % 2, int(k % 3 == 0)) for k, r in enumerate(rows) if k % 4] + [(700, 1, None), (700, None, 1), (None, 1, 1), (99999, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit("x")).withColumn("part", F.lit("y"))
    got = audit.audit_documents(frame(spark, rows).repartition(3), marks)
    assert result(got, *AUDIT_COLUMNS) == plain_audit(rows, labels)


def test_audit_of_no_rows_and_of_no_labels(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(audit.audit_documents(frame(spark, []), marks), "part") == []
    rows = [(1, None, None, None), (2, "", "", None)]
    assert result(audit.audit_documents(frame(spark, rows), marks), *AUDIT_COLUMNS) == plain_audit(rows, [])


def test_words_are_counted_over_pieces_of_a_text():
    raw = ("word " * 50 + "other one\t\n " + "x" * 40 + " Ü").encode()
    for size in (1, 7, 64, 10_000):
        assert [w for piece in audit.word_pieces(raw, size) for w in piece] == raw.split()


def test_packed_fields_do_not_overflow():
    """Sums near the greatest count a field may hold leave the neighbouring fields alone."""
    most = (1 << 62) - 1
    total = audit.packed(0b00011, 2, 0) * most + audit.packed(0b00001, 2, 0) * most
    found = audit.unpacked(total, 2, 0)
    assert found[0].tolist() == [[0, 2 * most, 0, most], [0, 0, most, 0]]
    assert found[1].tolist() == [[most, most, 0, 0], [0, most, most, most]]


def test_audit_of_other_filters_with_odd_names(spark):
    rows = [("p", True, False), ("p", None, True), (None, True, True)]
    df = spark.createDataFrame(rows, "part string, `x` boolean, `y` boolean").withColumn("mask", F.lit(1))
    got = {r["filter_order"] + str(r["step"]): r for r in audit.audit_filters(df.where("part = 'p'"), ["x", "y"], {}).collect()}
    assert (got["xy1"]["removed"], got["xy1"]["kept"], got["xy2"]["removed"], got["xy2"]["kept"]) == (1, 1, 1, 0)
    with pytest.raises(ValueError):
        audit.audit_filters(df, list("abcdefg"), {})


@pytest.mark.parametrize(("width", "percent"), [(2, 80), (4, 85), (1, 70)])
def test_minhash_groups_are_those_of_all_pairs(spark, width, percent):
    rows = corpus()
    options = {} if percent >= 80 else {"subkeys": 24}
    got = minhash.minhash_groups(frame(spark, rows), width=width, percent=percent, **options)
    expected = plain_groups(rows, width, percent)
    assert result(got, "doc_id", "n_shingles", "component_id") == expected
    assert result(got, "doc_id", "kept") == sorted(((i, i is None or i == c) for i, _, c in expected), key=repr)


def test_minhash_groups_of_near_copies_without_hub(spark):
    """Members differ from the base enough that many pairs of them aren't linked."""
    rng = random.Random(4)
    rows = []
    for i in range(80):
        words = [f"w{j}" for j in range(150)]
        for at in rng.sample(range(150), rng.choice([1, 3, 8, 12])):
            words[at] = f"v{rng.random()}"
        rows.append((i + 1, " ".join(words), "en", "s0"))
    got = minhash.minhash_groups(frame(spark, rows, extra=False))
    assert result(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 2, 80)


def test_minhash_of_versions_and_of_nothing(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join(words), "en", "s"), (2, "quite another text here", "en", "s"), (3, "quite another text here", "en", "s")]
    assert result(minhash.minhash_groups(frame(spark, rows)), "doc_id", "component_id") == [(1, 1), (2, 1), (2, 1), (3, 1)]
    assert result(minhash.minhash_groups(frame(spark, [])), "doc_id") == []
    assert result(minhash.minhash_groups(frame(spark, [(5, "", "en", "s"), (6, None, "en", "s")])), "doc_id", "n_shingles", "component_id", "kept") == [
        (5, 0, 5, True),
        (6, 0, 6, True),
    ]


def test_tables_are_met_as_often_as_computed():
    """Pairs of sets of a known similarity share a sub-key of both collections as often as the formula says."""
    rng = np.random.default_rng(7)
    hits, n = 0, 3000
    for _ in range(n):
        every = rng.integers(0, 1 << 63, 90, dtype=np.int64).astype(np.uint64)
        both = np.concatenate([every[:70], every[:50], every[70:90]])  # 50 of 90 elements in common
        left, right = minhash.collections(both, np.array([0, 70]), 4, 2)
        hits += (left[0] == left[1]).any() and (right[0] == right[1]).any()
    expected = 1 - minhash.miss_chance(50 / 90, 4, 2)
    assert abs(hits / n - expected) < 4 * (expected * (1 - expected) / n) ** 0.5
    assert minhash.miss_chance(0.8) < 1e-5


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_parity_sketches_bound_the_difference(spark, percent):
    """Similar sets are never rejected; unrelated and half similar ones of any size are."""
    rng = np.random.default_rng(percent)
    rows = []
    for size in (3, 20, 200, 2000, 20_000):
        shared = size * 2 * percent // (100 + percent) + 1
        for kind, common in (("near", shared), ("far", 0)):
            every = salted(rng.integers(0, 1 << 62, 2 * size - common, dtype=np.int64).astype(np.uint64), 1)
            a, b = np.sort(every[:size]), np.sort(np.concatenate([every[:common], every[size:]]))
            texts = np.repeat([0, 1], [len(a), len(b)])
            sizes = np.array([len(a), len(b)])
            bounds, words = parity.parity_sketches(texts, np.concatenate([a, b]), sizes, percent)
            rows.append((kind, size, len(a), len(b), words[: bounds[1]].tolist(), words[bounds[1] :].tolist()))
    df = spark.createDataFrame(rows, "kind string, size int, n_a long, n_b long, x array<long>, y array<long>")
    most = parity.most_difference("n_a", "n_b", percent)
    got = {(r["kind"], r["size"]): r["ok"] for r in df.withColumn("ok", F.expr(parity.sketches_allow("x", "y", most))).collect()}
    assert all(ok for (kind, _), ok in got.items() if kind == "near")
    assert not any(ok for (kind, size), ok in got.items() if kind == "far" and size >= 20)


def test_sketches_of_different_width_fold(spark):
    rng = np.random.default_rng(1)
    grams = salted(rng.integers(0, 1 << 62, 1200, dtype=np.int64).astype(np.uint64), 2)
    assert list(parity.parity_words(np.array([10, 1000, 1200]), 80)) == [16, 16, 32]
    sizes = np.array([1200, 1200])
    texts = np.repeat([0, 1], sizes)
    wide, _ = parity.parity_sketches(np.zeros(1200, np.int64), grams, np.array([1200]), 80)
    bounds, words = parity.parity_sketches(texts, np.concatenate([grams, grams]), sizes, 80)
    narrow_bounds, narrow = parity.parity_sketches(np.zeros(1000, np.int64), grams[:1000], np.array([1000]), 80)
    df = spark.createDataFrame([(words[: bounds[1]].tolist(), narrow.tolist())], "x array<long>, y array<long>")
    at = [df.select(F.expr(parity.sketches_allow("x", "y", str(k)))).first()[0] for k in (200, 0)]
    assert at == [True, False] and len(narrow) * 2 == bounds[1] and wide[1] == bounds[1] and narrow_bounds[1] == len(narrow)
