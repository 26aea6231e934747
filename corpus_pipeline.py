"""A corpus pipeline: languages, near duplicates, repeated passages, the mix of sources, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import bpe, jaccard, language, mixing, repeats
from stratalake.llm.queries import tokenizer
from stratalake.llm.rows import quoted, unpacked
from stratalake.sources.scratch import discard, store

#: Least chance of the predicted language; below it a text counts as of no known language.
LEAST_SCORE = 0.5
#: Part of the tokens that the mixing stage keeps.
SAMPLE_SHARE = 0.9


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or between languages go."""
    found = language.identify_languages(docs, tokenizer("piece_bpe_32k.model"), carry=True)
    return unpacked(found.where(f"lang_pred != 'und' AND score >= {LEAST_SCORE}"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies: 80 % of 5-word shingles or more. Rows without id stay."""
    groups = jaccard.jaccard_groups(docs, width=5, percent=80)
    gone = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*map(quoted, docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words or more that occur earlier; those of which nothing is left go."""
    found = repeats.without_repeats(docs, carry=True).where("n_removed = 0 OR n_removed < n_words")
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[(values[c] if c in values else F.col("row").getField(c)).alias(c) for c in docs.columns])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of most of the tokens, with tempered shares of sources, languages and topics."""
    return unpacked(mixing.mix(docs, share=SAMPLE_SHARE).where("selected"), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the kept documents' token ids and of what they decode to."""
    path = tokenizer("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(docs, path), path))


STAGES = [
    ("language_id", languages),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mixed),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: The first stage is a learnt model, which SQL can't state; the tests hold the pipeline against a plain version.
ORACLE_SQL = None
