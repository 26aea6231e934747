import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from corpus import corpus, frame, result
from tokenizers import Tokenizer

from stratalake.llm import bpe, tokencount
from stratalake.llm.bpefile import PATTERN, BpeFile, Splitter

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", "é", "'", "'s", "'ll", "'re", " ", "  ", "\n", "\t", "1", "²", "½", "!", "<|endoftext|>", "<|endo", "中", "文", "😀", "re", "ll", "l", "_", "\x1c", "\x85", "the", " in"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(n)]


def test_splitter_follows_the_pattern():
    import regex

    splitter = Splitter()
    for text in random_texts(2000):
        starts = splitter.bounds(text)[1].tolist()
        assert [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=False)] == regex.findall(PATTERN, text)


def test_counts_are_the_librarys(library):
    texts = random_texts(1500, seed=2)
    assert tokencount.Counter(BpeFile(PATH)).counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]


def test_merging_takes_the_leftmost_of_equal_pairs():
    pairs, made = {(1 << 32 | 1): 0}, [2]
    assert tokencount.tokens_left([1, 1, 1], pairs, made) == 2
    assert tokencount.tokens_left([], pairs, made) == 0
    assert tokencount.tokens_left([1] * 9, {(1 << 32 | 1): 0, (2 << 32 | 2): 1}, [2, 3]) == 3


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencount, "CACHED", 5)
    texts = random_texts(50, seed=3)
    assert tokencount.Counter(BpeFile(PATH)).counts(texts).tolist() == [len(ids_of(library, t)) for t in texts]


@pytest.mark.parametrize("leaf", [1, 3, 11])
def test_tree_joins_to_the_librarys_ids(library, leaf):
    encoder = bpe.Encoder(BpeFile(PATH))
    for text in [*random_texts(400, seed=leaf), *("".join(random.Random(i).choices("abcthe", k=60)) for i in range(100))]:
        assert encoder.tree(text, leaf).tolist() == ids_of(library, text)


def test_unsplit_run_of_letters(library):
    text = "".join(random.Random(4).choices("abcdefgh", k=30_000))
    assert bpe.Encoder(BpeFile(PATH)).tree(text, 1000).tolist() == ids_of(library, text)


def test_token_counts_of_a_table(spark, library):
    rows = corpus()
    got = tokencount.token_counts(frame(spark, rows), PATH, limit=100)
    expected = [(i, len((t or "").encode()), n := len(ids_of(library, t)), n > 100) for i, t, *_ in rows]
    assert result(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


@pytest.mark.parametrize("leaf", [200, 16_384])
def test_round_trip_of_a_table(spark, library, leaf):
    rows = corpus()
    df = frame(spark, rows)
    got = bpe.digests(bpe.decode(bpe.encode(df, PATH, leaf_chars=leaf), PATH))
    expected = []
    for i, t, *_ in rows:
        ids = ids_of(library, t)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        expected.append((i, len(ids), *sha))
    assert result(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)


def test_decoding_takes_null_lists_and_broken_characters(spark, library):
    ids = ids_of(library, "中")[:1]
    df = spark.createDataFrame([(1, None), (2, []), (3, ids)], "doc_id long, ids array<int>")
    assert result(bpe.decode(df, PATH), "doc_id", "decoded") == [(1, ""), (2, ""), (3, library.decode(ids))]


def test_empty_table(spark):
    assert result(tokencount.token_counts(frame(spark, []), PATH, limit=1), "doc_id") == []
    assert result(bpe.decode(bpe.encode(frame(spark, []), PATH), PATH), "doc_id") == []


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="no plain byte-level"):
        BpeFile(public_tokenizers.path("word_bpe_49k.json"))


def test_widths_and_letters():
    encoder = bpe.Encoder(BpeFile(PATH))
    assert encoder.widths[encoder.encode("<|endoftext|>")].tolist() == [13]
    assert np.array_equal(encoder.join(["", "ab"], [np.zeros(0, np.int32), encoder.encode("ab")]), encoder.encode("ab"))
    assert re.fullmatch(r"[a-z]+", encoder.decode(encoder.encode("abc")))
