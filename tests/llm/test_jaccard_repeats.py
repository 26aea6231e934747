import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from corpus import corpus, frame, result
from pyspark.sql import functions as F

from stratalake.llm import jaccard, repeats
from stratalake.llm.components import connected_components
from stratalake.llm.wordhash import Words, salted

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def plain_groups(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t, *_ in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted(((i, len(s), None if i is None else root(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (2, 70), (1, 50)])
def test_groups_are_those_of_all_pairs(spark, width, percent):
    rows = corpus()
    got = jaccard.jaccard_groups(frame(spark, rows), width=width, percent=percent)
    assert result(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, width, percent)


def test_group_of_near_copies_needs_no_hub(spark):
    """Members differ from the base enough that many pairs of them aren't linked."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(200), rng.choice([1, 4, 7])):
            words[at] = f"v{rng.random()}"
        rows.append((i + 1, " ".join(words), "en", "s0"))
    got = jaccard.jaccard_groups(frame(spark, rows, extra=False))
    assert result(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 4, 85)


def test_links_are_counted_between_all_different_sets(spark):
    """Twelve texts that are all linked, three copies of one of them, and the corpus."""
    base = [f"w{i}" for i in range(200)]
    rows = [(1000 + i, " ".join([*base[: i * 9], f"v{i}", *base[i * 9 + 1 :]]), "en", "s0") for i in range(12)]
    rows += [(1100 + i, rows[4][1], "en", "s0") for i in range(3)] + corpus(n=60)
    sets = {i: frozenset(shingles(t, 4)) for i, t, *_ in rows if i is not None}
    kinds = {s for s in sets.values() if s}
    expected = {i: sum(s != o and 100 * len(s & o) >= 85 * len(s | o) for o in kinds) if s else 0 for i, s in sets.items()}
    assert expected[1000] == 11 and expected[1100] == 11
    got = jaccard.jaccard_groups(frame(spark, rows), count_links=True)
    assert {i: n for i, n in result(got, "doc_id", "n_links") if i is not None} == expected
    assert result(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 4, 85)
    assert "n_links" not in jaccard.jaccard_groups(frame(spark, rows[:3])).columns


def test_bands_leave_an_untouched_block():
    """Bands have no gaps, and the smallest set of each is dealt into too few blocks of all partitions with a chance of 1e-9 at most."""
    for percent in (50, 80, 85, 100):
        lows, highs, blocks, partitions = jaccard.size_bands(percent)
        assert (lows[1:] == highs[:-1] + 1).all()
        for low, high, m, k in zip(lows[:30].tolist(), highs.tolist(), blocks.tolist(), partitions.tolist()):
            assert jaccard.chance_of_few(low, m, 2 * high * (100 - percent) // (100 + percent)) ** k <= 1e-9


def test_chance_of_few_blocks():
    rng = np.random.default_rng(1)
    dealt = np.array([len(np.unique(rng.integers(0, 12, 9))) for _ in range(20_000)])
    for most in (4, 5, 6, 7):
        assert abs((dealt <= most).mean() - jaccard.chance_of_few(9, 12, most)) < 0.02
    assert abs(jaccard.chance_of_few(400, 150, 138) - jaccard.chance_of_few(401, 150, 138)) < 0.05


def pair_rows(spark, sizes, percent, n, seed=1):
    """Signatures shared by sets that have no element in common."""
    rng = np.random.default_rng(seed)
    own = rng.integers(sizes[0], sizes[1] + 1, n)
    texts = np.repeat(np.arange(n), own)
    grams = salted(rng.integers(0, 1 << 62, len(texts), dtype=np.int64).astype(np.uint64), 1)
    owners, signatures = jaccard.block_signatures(texts, grams, own, percent)
    return len(signatures) - len(np.unique(signatures)), len(signatures) / len(texts)


@pytest.mark.parametrize("percent", [50, 80, 85])
@pytest.mark.parametrize(("sizes", "n"), [((1, 4), 4000), ((5, 30), 4000), ((100, 140), 2000), ((400, 600), 500), ((15_000, 20_000), 10)])
def test_unrelated_sets_share_no_signature(spark, sizes, n, percent):
    shared, each = pair_rows(spark, sizes, percent, n)
    assert shared == 0
    assert each < (1 if percent >= 80 and sizes[0] >= 100 else 25)


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_similar_sets_share_a_signature(percent):
    """Pairs at the threshold, of every size and share of additions and removals."""
    rng = np.random.default_rng(percent)
    for size in [*range(1, 40), 60, 100, 250, 1000, 3000]:
        for _ in range(12):
            shared = int(rng.integers(max(1, size * percent // 100), size + 1))
            extra = rng.integers(0, max(1, shared * 100 // percent - size + 1))
            a = rng.integers(0, 1 << 62, size + int(extra), dtype=np.int64).astype(np.uint64)
            sets = [salted(a[:size], 1), salted(np.concatenate([a[:shared], a[size:]]), 1)]
            if 100 * shared < percent * (size + int(extra)):
                continue
            sizes = np.array([len(s) for s in sets])
            owners, signatures = jaccard.block_signatures(np.repeat([0, 1], sizes), np.concatenate(sets), sizes, percent)
            assert set(signatures[owners == 0].tolist()) & set(signatures[owners == 1].tolist()), (size, shared, extra)


def test_empty_table_and_no_links(spark):
    assert result(jaccard.jaccard_groups(frame(spark, [])), "doc_id") == []
    assert result(repeats.without_repeats(frame(spark, [])), "doc_id") == []
    assert result(connected_components(spark.createDataFrame([], "a long, b long")), "node") == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(5, 5), (None, 3), (141, 139)]
    got = result(connected_components(spark.createDataFrame(links, "a long, b long")), "node", "component")
    assert got == sorted([(i, 100) for i in range(100, 142) if i != 141] + [(141, 100)] + [(i, 7) for i in range(7, 60)], key=repr)


def plain_without_repeats(rows, length):
    """Windows are judged on the input; only rows with an id count, equal (id, place) don't precede each other."""
    first = {}
    for i, t, *_ in rows:
        w = WORDS.findall(t or "")
        for p in range(len(w) - length + 1) if i is not None else ():
            key = tuple(w[p : p + length])
            first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for i, t, *_ in rows:
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for p in range(len(w) - length + 1) if i is not None else ():
            if first[tuple(w[p : p + length])] < (i, p):
                gone[p : p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [20, 31, 6, 3, 1])
def test_repeats_are_those_of_all_windows(spark, length):
    rows = corpus()
    got = repeats.without_repeats(frame(spark, rows).repartition(5), length=length)
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_without_repeats(rows, length)


def test_levels_double_up_to_the_length():
    assert [repeats.window_lengths(n) for n in (1, 5, 6, 20, 31, 64, 200)] == [[1], [5], [3, 6], [5, 10, 20], [4, 8, 16, 31], [4, 8, 16, 32, 64], [4, 7, 13, 25, 50, 100, 200]]
    for n in range(1, 300):
        lengths = repeats.window_lengths(n)
        assert lengths[-1] == n and lengths[0] <= repeats.SHORTEST and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:]))
    with pytest.raises(ValueError):
        repeats.window_lengths(0)


def test_shorter_windows_lie_in_each_other():
    words = Words(pa.array([" ".join(f"w{i % 37}" for i in range(400)), "", "one two", " ".join(f"v{i}" for i in range(90))]))
    for n in (1, 6, 20, 31, 64):
        lengths = repeats.window_lengths(n)
        starts, levels = repeats.level_starts(words, words.hashes(), lengths)
        assert len(starts) == (400 - n + 1) + (2 - n + 1 if n < 3 else 0) + (90 - n + 1)
        assert (levels[-1] == starts).all()
        for (a, x), (b, y) in zip(zip(lengths, levels), list(zip(lengths, levels))[1:]):
            assert ((y <= x) & (x + a <= y + b)).all()


@pytest.mark.parametrize("length", [30, 31, 32, 64, 80, 200])
def test_long_windows_go_from_every_later_document(spark, length):
    """Six documents share a passage, each behind words of its own."""
    passage = " ".join(f"p{i}" for i in range(210))
    rows = [(i, f"own{i} " * (3 + i) + passage + f" end{i}" * 4, "en", "s") for i in range(6)]
    got = repeats.without_repeats(frame(spark, rows), length=length)
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_without_repeats(rows, length)
    assert [r[0] for r in result(got, "n_removed")] == [0, *[210] * 5] or length > 30


def test_no_candidates_survive_a_level(spark):
    """Windows of five words are repeated, but none of ten."""
    common = " ".join(f"c{i}" for i in range(6))
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(12)) + f" {common} " + " ".join(f"b{i}x{j}" for j in range(12)), "en", "s") for i in range(8)]
    got = repeats.without_repeats(frame(spark, rows))
    assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_without_repeats(rows, 20)


def test_repeats_across_slices_and_partitions(spark):
    rows = corpus(seed=9, n=60)
    for partitions in (1, 6):
        got = repeats.without_repeats(frame(spark, rows).repartition(partitions), length=8)
        assert result(got, "doc_id", "n_words", "n_removed", "kept_sha256") == plain_without_repeats(rows, 8)


def test_kept_text_has_the_kept_words_and_its_own_space(spark):
    repeated = " ".join(f"r{i}" for i in range(25))
    rows = [(1, f"start\n{repeated}\nend", "en", "s"), (2, f"other\tbegin {repeated}  and\nthen", "en", "s"), (3, repeated, "en", "s")]
    got = repeats.without_repeats(frame(spark, rows), carry=True)
    assert got.schema["row"].dataType.names == [c for c in frame(spark, []).columns if c not in ("doc_id", "text")]
    assert result(got.select(F.col("row").getField("a.b").alias("x"), F.col("row").getField("back`quote").alias("y")).distinct(), "x", "y") == [("a.b", "back`quote")]
    assert result(repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, lang string, s string").select("doc_id", "text"), carry=True), "doc_id") == [(1,), (2,), (3,)]
    assert result(got, "doc_id", "kept_text", "row.lang") == [(1, f"start\n{repeated}\nend", "en"), (2, "other\tbegin and\nthen", "en"), (3, "", "en")]


def test_versions_of_one_id_are_told_apart(spark):
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join(words[:25]) + " x", "en", "s"), (2, "quite another text " * 12, "en", "s")]
    got = result(repeats.without_repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed")
    assert got == [(1, 30, 0), (2, 26, 25), (2, 36, 33)]
