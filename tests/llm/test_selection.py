import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import corpus, frame, result
from pyspark.sql import functions as F

from stratalake.llm import mixing, outliers, urlmodel
from stratalake.llm.queries import URL_RULES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    w = WORDS.findall(text)
    times = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {p for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def plain_verdicts(rows, least, share=0.75, rounds=4, usual=12.83, cut=50.0):
    """The same estimates with numpy: pools, quartiles, concentration steps, the last step and distances."""
    stats = [statistics(t) for _, t, *_ in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    keys = [((lang or ""), (src or "")) for _, _, lang, src in rows]
    size = Counter(k for k, f in zip(keys, failed, strict=True) if not f)
    others = Counter()
    for (lang, _), n in size.items():
        others[lang] += n if n < least else 0
    pools = defaultdict(list)
    for i, (k, f) in enumerate(zip(keys, failed, strict=True)):
        if not f:
            pools[k if size[k] >= least else k[0] if others[k[0]] >= least else None].append(i)
    floors = np.array([f for _, f in outliers.TRANSFORMS.values()]) ** 2
    kept = [False] * len(rows)
    for members in pools.values():
        x = np.array(
            [
                [math.log(1 + n), math.log((1 + c) / (1 + n)), math.log(1 + 1000 * y / (1 + c)), math.log(1 + d), math.log(1 + 20 * r / (1 + n))]
                for n, c, y, d, r in (stats[i] for i in members)
            ]
        )
        quartiles = np.array([[(np.sort(np.floor(col * 64))[math.ceil(q * len(col)) - 1] + 0.5) / 64 for col in x.T] for q in (0.25, 0.5, 0.75)])
        mean, cov = quartiles[1], np.diag(((quartiles[2] - quartiles[0]) / 1.349) ** 2 + floors)

        def distance(mean, cov, x=x):
            return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

        for within in [0.0] * rounds + [usual]:
            d = distance(mean, cov)
            bins = np.floor(np.log(1 + d) * 64)
            near = x[(bins <= np.sort(bins)[math.ceil(share * len(x)) - 1]) | (d <= within)]
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True).reshape(5, 5) + np.diag(floors)
        for i, d in zip(members, distance(mean, cov), strict=True):
            kept[i] = bool(d <= cut)
    return sorted(((r[0], *s, f, k) for r, s, f, k in zip(rows, stats, failed, kept, strict=True)), key=repr)


def quality_rows():
    rows = corpus(seed=11, n=150)
    rows += [(900 + i, " ".join(f"%%{k}{i}$$" for k in range(70)), "en", "s0") for i in range(6)]
    rows += [(950, "\n".join(["the same line with quite a few words in it"] * 20), "en", "s0"), (951, "|" * 70_000, "en", "s0")]
    return rows


@pytest.mark.parametrize("least", [20, 1000])
def test_verdicts_are_those_of_numpy(spark, least):
    rows = quality_rows()
    got = outliers.quality_verdicts(frame(spark, rows), least=least)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert result(got, *columns) == plain_verdicts(rows, least)


def test_symbols_are_rejected_and_prose_is_kept(spark):
    got = {r[0]: r[1] for r in result(outliers.quality_verdicts(frame(spark, quality_rows()), least=1000), "doc_id", "kept")}
    assert not any(got[900 + i] for i in range(6))
    prose = [i for i, t, *_ in corpus(seed=11, n=150) if i is not None and statistics(t)[0] >= 60 and statistics(t)[4] * 10 < statistics(t)[0]]
    assert sum(got[i] for i in prose) >= 0.98 * len(prose)


def test_quality_runs_without_python(spark):
    plan = outliers.quality_verdicts(frame(spark, corpus(n=20), extra=False))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(spark):
    assert result(outliers.quality_verdicts(frame(spark, [])), "doc_id") == []
    assert result(mixing.mix(frame(spark, [])), "weight") == []
    assert result(urlmodel.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES), "page_id") == []


def raked(rows, targets, rounds):
    tokens = Counter()
    for _, t, lang, src in rows:
        tokens[(src or "", lang or "", topic(t))] += len(WORDS.findall(t or ""))
    f = dict.fromkeys(tokens, 1.0)
    total = sum(tokens.values())
    shares = []
    for m in range(3):
        sums = Counter()
        for cell, n in tokens.items():
            sums[cell[m]] += n
        if targets.get(m) is not None:
            shares.append({k: v / sum(targets[m].values()) for k, v in targets[m].items()})
        else:
            z = sum(v**0.9 for v in sums.values())
            shares.append({k: v**0.9 / z for k, v in sums.items()})
    for _ in range(rounds):
        for m in range(3):
            sums = Counter()
            for cell, n in tokens.items():
                sums[cell[m]] += n * f[cell]
            f = {c: v * (shares[m].get(c[m], 0.0) * total / sums[c[m]] if sums[c[m]] > 0 else 1.0) for c, v in f.items()}
    return tokens, f


def topic(text):
    return next((n for n, p in mixing.TOPICS.items() if re.search(p, text or "")), "prose")


@pytest.mark.parametrize("lang_target", [None, {"en": 1.0, "de": 2.0, "fr": 1.0, "": 0.5}])
def test_weights_are_those_of_plain_raking(spark, lang_target):
    rows = [(i, (t + " | a | b | c") if t and i and i % 4 == 0 else t, lang, src) for i, t, lang, src in corpus(seed=2)]
    tokens, f = raked(rows, {1: lang_target}, mixing.ROUNDS)
    largest = max(v for c, v in f.items() if tokens[c] > 0)
    expected = []
    for i, t, lang, src in rows:
        w = f[(src or "", lang or "", topic(t))]
        p = min(1.0, w / largest)
        u = int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16) / 2**52
        expected.append((i, len(WORDS.findall(t or "")), round(w, 9), round(p, 9), u < p))
    got = mixing.mix(frame(spark, rows), targets={"lang": lang_target} if lang_target else None)
    got = got.select(F.col("row.doc_id"), "n_tokens", F.round("weight", 9).alias("w"), F.round("probability", 9).alias("p"), "selected", "row")
    assert result(got, "doc_id", "n_tokens", "w", "p", "selected") == sorted(expected, key=repr)
    assert got.schema["row"].dataType.names == frame(spark, []).columns


def test_margins_meet_their_targets(spark):
    rows = corpus(seed=2)
    target = {"en": 0.5, "de": 0.3, "fr": 0.19, "": 0.01}
    got = mixing.mix(frame(spark, rows), targets={"lang": target}, rounds=40)
    sums = {r["lang"]: r["t"] for r in got.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("weight")).alias("t")).collect()}
    total = sum(sums.values())
    for lang, share in target.items():
        if sums.get(lang):
            assert sums[lang] / total == pytest.approx(share / (1 if sums.get("") else 0.99), rel=0.05)


def test_size_is_met_whatever_a_stray_row_weighs(spark):
    rows = [r for r in corpus(seed=2) if r[0] is None or r[0] < 500]
    stray = [*rows, (9001, "word " * 60, None, "unseen")]
    tokens = sum(len(WORDS.findall(t or "")) for _, t, *_ in rows)
    got = mixing.mix(frame(spark, stray), size=tokens * 0.9, rounds=4).collect()
    assert sum(r["n_tokens"] * r["probability"] for r in got) == pytest.approx(tokens * 0.9)
    assert sum(r["n_tokens"] * r["probability"] for r in got if r["row"]["doc_id"] != 9001) >= tokens * 0.9 - 60 - 1e-6  # all but the stray row's own 60
    scale = max(r["probability"] / r["weight"] for r in got if r["n_tokens"])
    assert all(r["probability"] == pytest.approx(min(1.0, scale * r["weight"])) for r in got)
    assert all(r["shortfall"] == pytest.approx(max(0.0, 1 - 1 / max(1.0, scale * r["weight"])), abs=1e-9) for r in got)


def test_a_stray_row_moves_the_sample_by_less_than_a_hundredth(spark):
    rows = [r for r in corpus(seed=2) if r[0] is not None and r[0] < 500]
    chances = []
    for more in ([], [(9001, "word " * 60, None, "unseen")]):
        got = mixing.mix(frame(spark, rows + more), share=0.5, carry=["doc_id"])
        assert got.select("row.*").columns == ["doc_id"]
        chances.append(sorted((r["row"]["doc_id"], r["n_tokens"] * r["probability"]) for r in got.collect() if r["row"]["doc_id"] != 9001))
    total = sum(p for _, p in chances[0])
    assert total == pytest.approx(0.5 * sum(len(WORDS.findall(t or "")) for _, t, *_ in rows))
    assert abs(sum(p for _, p in chances[1]) - total) < 0.01 * total


def test_chances_fill_a_given_size(spark):
    cells = spark.createDataFrame([(1000, 1.0), (500, 0.5), (10, 40.0), (20, 3.0), (7, 0.0), (0, 99.0)], "tokens long, f double")
    for size in (0, 200, 700, 1300, 1529):
        c = mixing.calibrated(cells, size)
        assert sum(t * min(1.0, c * f) for t, f in ((1000, 1.0), (500, 0.5), (10, 40.0), (20, 3.0))) == pytest.approx(size)
    assert mixing.calibrated(cells, 1600) == math.inf


URLS = (
    [f"https://www.shop{i % 5}.com/fr/{i}?x=1" for i in range(40)]
    + [f"http://a{i % 3}.example.com/en/{i}#top" for i in range(40)]
    + [f"https://News{i}.net/es/casa-{i}" for i in range(30)]
    + [f"https://blog.org/en/{i}" for i in range(20)]
    + [f"https://spam.net/de/{i}" for i in range(20)]
    + ["https://www.EXAMPLE.com/en/page", "https://example.com", "https://example.com?x=/en/", "no scheme", "", None, "x://", "http://http://a.com/en/", "https://com/", "https://notexample.com/en/", "https://net/fr/" + "long/" * 3000, "https://example.com/EN/"]
)


def plain_urls(urls, order=urlmodel.ORDER):
    parsed = []
    for u in urls:
        rest = (u or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fit = [r for r in URL_RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith(r[0][r[0].index("/") :])]
        rule = max(fit, key=lambda r: len(r[0]), default=(None, None))
        address = re.sub("[0-9]", "0", urlmodel.EDGE + ".".join(reversed(host.split("."))) + path + urlmodel.EDGE)
        parsed.append((host, path, *rule, address))
    grams = defaultdict(lambda: [0, 0])
    for *_, verdict, a in parsed:
        if verdict:
            for k in range(1, order + 2):
                for i in range(max(len(a) - k + 1, 1)):
                    grams[a[i : i + k]][verdict == "block"] += 1
    totals = Counter()
    for g, (x, y) in grams.items():
        totals[len(g)] += x + y
    models = urlmodel.CharacterModels({g: tuple(v) for g, v in grams.items() if sum(v) >= totals[len(g)] * urlmodel.SHARE}, order)
    scores = [models.score(a) for *_, a in parsed]
    bins = sorted({math.floor(s / urlmodel.BIN) for s, p in zip(scores, parsed, strict=True) if p[3]})
    judged = [(math.floor(s / urlmodel.BIN), p[3]) for s, p in zip(scores, parsed, strict=True) if p[3]]
    n = Counter(v for _, v in judged)

    def wrong(edge):
        return sum(b < edge for b, v in judged if v == "allow") / n["allow"] + sum(b >= edge for b, v in judged if v == "block") / n["block"]

    edges = [*bins, bins[-1] + 1]
    least = min(map(wrong, edges))
    best = [e for e in edges if wrong(e) <= least + 1e-9]
    threshold = (best[0] + best[-1]) * urlmodel.BIN / 2
    return [(h, p, r, v or ("allow" if s >= threshold else "block")) for (h, p, r, v, _), s in zip(parsed, scores, strict=True)]


def test_urls_are_judged_like_plainly(spark):
    rows = list(enumerate(URLS)) + [(None, "https://blog.org/en/1"), (3, URLS[3])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "path", "rule", "verdict", "score", "address", "html")})
    expected = [(i, *row) for (i, _), row in zip(rows, plain_urls([u for _, u in rows]), strict=True)]
    assert result(urlmodel.judge_urls(df, URL_RULES), "page_id", "host", "path", "rule", "verdict") == sorted(expected, key=repr)


def test_rules_of_the_contract(spark):
    urls = {
        "https://x.example.com/en/1": ("example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "https://a.www.example.com/en/": ("www.example.com/en/", "allow"),
        "https://example.com/fr/": ("com/", "allow"),
        "https://a.net/es/1": ("net/es/", "block"),
        "https://a.net/fr/1": ("net/fr/", "block"),
        "https://a.net/fr": (None, None),
        "https://a.com": (None, None),
    }
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r[0]: r[1:] for r in result(urlmodel.judge_urls(df, URL_RULES), "page_id", "rule", "verdict")}
    for i, (rule, verdict) in enumerate(urls.values()):
        assert got[i][0] == rule and (verdict is None or got[i][1] == verdict)


def test_models_tell_unseen_hosts_apart(spark):
    rows = list(enumerate([*URLS, "https://news7.net/de/casa-31", "https://www.shop8.org/fr/12"]))
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r[0]: r[1:] for r in result(urlmodel.judge_urls(df, URL_RULES), "page_id", "rule", "verdict", "score")}
    like_blocked, like_allowed = got[len(URLS)], got[len(URLS) + 1]
    assert like_blocked[:2] == (None, "block") and like_allowed[:2] == (None, "allow") and like_blocked[2] < like_allowed[2]


def test_rare_strings_are_counted_among_many(spark):
    """Far more than 40,000 strings of a length, so that a string seen a few times makes up less than 1 / 40,000 of them."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12))
    urls = [f"https://{word()}.com/fr/{word()}" for _ in range(3500)] + [f"https://{word()}.net/es/{word()}" for _ in range(1200)]
    urls += [f"https://a{i}.net/fr/qzjxkv" for i in range(3)] + [f"https://b{i}.com/qzjxkw" for i in range(3)] + ["https://c.org/qzjxkv", "https://c.org/qzjxkw"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = urlmodel.judge_urls(df, URL_RULES)
    got = {r["page_id"]: r for r in rows.collect()}
    grams, total = Counter(), defaultdict(lambda: [0, 0])
    for i, r in got.items():
        if r["rule"]:
            a = re.sub("[0-9]", "0", urlmodel.EDGE + ".".join(reversed(r["host"].split("."))) + r["path"] + urlmodel.EDGE)
            for k in range(1, urlmodel.ORDER + 2):
                for j in range(max(len(a) - k + 1, 1)):
                    total[a[j : j + k]][r["verdict"] == "block"] += 1
                    grams[k] += 1
    assert min(grams[k] for k in (5, 6)) > 3 * 40_000 and sum(total["qzjxkv"]) <= 3
    models = urlmodel.CharacterModels({g: tuple(v) for g, v in total.items()}, urlmodel.ORDER)
    for i, r in got.items():
        a = re.sub("[0-9]", "0", urlmodel.EDGE + ".".join(reversed(r["host"].split("."))) + r["path"] + urlmodel.EDGE)
        assert r["score"] == pytest.approx(models.score(a), abs=1e-9), urls[i]
    assert got[len(urls) - 2]["score"] < got[len(urls) - 1]["score"]
