"""Small texts with the cases every operator has to take: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
EXTRA = "n sig rep a b c row ids decoded place seed windows found mark piece tokens u weight topic score pool bin x1 m_0 held_out words body keys part vector q v f s".split()
EXTRA = list(dict.fromkeys([*EXTRA, *["a b", "x-y", "a.b", "_", "found", "hash", "place", "nothing", "hashes", "row.a", "struct", "back`quote", "digest", "flags", "mask"]]))
VOCABULARY = {
    "en": "the of and to in is that house water green walking nothing under stone river light".split(),
    "de": "der die und in den von zu das haus wasser grün gehen nichts unter stein fluß licht".split(),
    "fr": "le la et les des en un du maison eau vert marcher rien sous pierre rivière été".split(),
}


def sentences(rng, lang, n):
    words = [rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "", ",", "."]) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for w in words)


def corpus(seed=5, n=90):
    """(doc_id, text, lang, source) rows."""
    rng = random.Random(seed)
    passage = sentences(rng, "en", 60)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", "fr"])
        text = sentences(rng, lang, rng.choice([3, 12, 30, 80, 150]))
        if i % 7 == 0:
            text = sentences(rng, lang, 10) + passage + text
        if i % 5 == 0 and rows:
            text = rng.choice(rows)[1] or ""
            if rng.random() < 0.7:
                words = text.split(" ")
                words[len(words) // 2] = "changed"
                text = " ".join(words)
        rows.append((i * 3, text, lang, rng.choice(["s0", "s0", "s1", None])))
    rows += [(1, None, "en", "s0"), (2, "", None, None), (4, " \n\t ", "de", "s1"), (5, "one", "en", "s1"), (7, "One two three", "en", "s1"), (8, "one Two three ", "fr", "s1")]
    rows += [(10, "¿!? 12 34 … 😀", "en", "s1"), (16, "² ½ Ⅻ 5", "en", "s1"), (11, "tab\tand\x0bvertical\x0cfeed\r\nline", "en", "s1"), (13, "nbsp is a letter here too", "en", None)]
    long = sentences(rng, "en", 30_000)
    rows += [(500, long, "en", "s0"), (501, long, "en", "s0"), (502, "x" * 50_000, "de", "s0"), (503, "again and again " * 4_000, "en", "s1")]
    rows += [rows[3], rows[3], rows[20]]  # repeated rows
    rows += [(None, rows[6][1], "en", "s0"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra=True):
    out = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], SCHEMA)
    return out.select("*", *[F.lit(c).alias(c) for c in EXTRA]) if extra else out


def result(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
