import hashlib
import re

import pytest
from corpus import corpus, frame, result
from test_jaccard_repeats import plain_groups, plain_without_repeats
from test_selection import raked, topic
from test_tokens import PATH, ids_of
from tokenizers import Tokenizer

import corpus_pipeline
from stratalake.llm import language, mixing
from stratalake.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    words = [f"w{i}" for i in range(100)]
    between = [(2000 + k, " ".join([*words, *(f"n{k}x{i}" for i in range(more))]), "en", "s0") for k, more in enumerate((0, 20))]  # alike by five words and 80 %, not by four and 85
    frame(spark, corpus(seed=12, n=80) + between).write.parquet(f"{path}/documents.parquet")
    return str(path)


def text_rows(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def test_stages_are_those_of_the_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "substring_dedup", "mixing", "bpe"]

    one = stages["language_id"](spark, docs, folder)
    known = language.identify_languages(docs, corpus_pipeline.tokenizer("piece_bpe_32k.model"), carry=True)
    assert result(one, "doc_id", "text", "lang") == result(known.where("lang_pred != 'und' AND score >= 0.5").select("row.*"), "doc_id", "text", "lang")
    assert one.columns == docs.columns
    before = text_rows(one)
    assert len(before) > 60 and all(any(c.isalpha() for c in t) for _, t, *_ in before)

    two = stages["near_duplicates"](spark, one, folder)
    groups = {i: g for i, _, g in plain_groups(before, 5, 80)}
    assert groups != {i: g for i, _, g in plain_groups(before, 4, 85)}
    kept = [r for r in before if r[0] is None or groups[r[0]] == r[0]]
    assert result(two, "doc_id", "text", "lang", "source") == sorted(kept, key=repr)
    assert two.columns == docs.columns

    three = stages["substring_dedup"](spark, two, folder)
    plain = plain_without_repeats(kept, 20)
    digest = lambda t: hashlib.sha256(" ".join(WORDS.findall(t)).encode()).hexdigest()
    after = text_rows(three)
    assert sorted(((i, digest(t)) for i, t, *_ in after), key=repr) == sorted(((i, s) for i, n, gone, s in plain if not n or gone < n), key=repr)
    assert three.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in three.collect())

    four = stages["mixing"](spark, three, folder)
    tokens, f = raked(after, {}, mixing.ROUNDS)
    low, high = 0.0, 1e6
    for _ in range(200):  # the scale at which all cells give the wanted part of the tokens
        c = (low + high) / 2
        low, high = (c, high) if sum(n * min(1.0, c * f[cell]) for cell, n in tokens.items()) < corpus_pipeline.SAMPLE_SHARE * sum(tokens.values()) else (low, c)
    chosen = []
    for i, t, lang, src in after:
        u = int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:13], 16) / 2**52
        if u < min(1.0, c * f[(src or "", lang or "", topic(t))]):
            chosen.append((i, t))
    assert result(four, "doc_id", "text") == sorted(chosen, key=repr)

    five = stages["bpe"](spark, four, folder)
    library = Tokenizer.from_file(PATH)
    expected = []
    for i, t in chosen:
        ids = ids_of(library, t)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert result(five, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert result(corpus_pipeline.run(spark, folder), *five.columns) == sorted(expected, key=repr)


def test_near_copies_by_five_words_and_four_fifths(spark, tmp_path):
    """Copies with a 5-word similarity from 0.80 to 0.85, and one just below."""
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words), "en", "s0")]
    rows += [(2 + k, " ".join([*words, *(f"n{k}x{i}" for i in range(more))]), "en", "s0") for k, more in enumerate((18, 24, 25))]
    groups = {i: g for i, _, g in plain_groups(rows, 5, 80)}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4} and {g for _, _, g in plain_groups(rows, 4, 85)} == {1, 2, 3, 4}
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows, extra=False), str(tmp_path))
    assert result(got, "doc_id") == [(1,), (4,)]


def test_empty_documents(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert result(corpus_pipeline.run(spark, str(tmp_path)), "doc_id") == []


def test_every_operator_has_a_query():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))
