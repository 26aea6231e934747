"""From bucket keys to groups of similar shingle sets: candidates, confirmation on whole sets, components."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.components import connected_components
from stratalake.llm.parity import FIXED, fixed_allow, fixed_sketches, most_difference, parity_sketches, sizes_allow, sketches_allow
from stratalake.llm.wordhash import Words, range_hashes, salted, signed, slices
from stratalake.sources.scratch import discard, store

LONGS = T.ArrayType(T.LongType(), False)
#: What is known of a document's set: its size, a 128-bit sum of its hashes, and two parity sketches, of fixed width and as wide as the set needs.
FACTS = [T.StructField(c, T.LongType()) for c in ("doc_id", "n", "fp1", "fp2", *FIXED)] + [T.StructField("sketch", LONGS)]
KIND = ["n", "fp1", "fp2"]
#: Bucket rows that one task makes.
ROWS_PER_TASK = 2_000_000
#: Hubs a set is compared with before what is left is compared across components.
HUBS = 2


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, as (text, hash) sorted by both; a short text is one shingle."""
    hashes, counts = words.hashes(), words.counts
    starts, grams = words.windows(hashes, width)
    texts = words.texts()[starts]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        grams = np.concatenate([grams, range_hashes(hashes, words.first[short], words.first[short + 1])])
        texts = np.concatenate([texts, short])
    order = np.lexsort((grams, texts))
    texts, grams = texts[order], grams[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (grams[1:] != grams[:-1])
    return texts[new], grams[new]


def set_facts(ids: pa.Array, texts: np.ndarray, grams: np.ndarray, sizes: np.ndarray, percent: int, seen: set) -> tuple[list[pa.Array], np.ndarray]:
    """The columns of ``FACTS``, and which rows have an id and a set that ``seen`` lacks; these sets are added to it."""
    rows = len(sizes)
    prints = []
    for salt in (3, 4):
        total = np.zeros(rows, np.uint64)
        np.add.at(total, texts, salted(grams, salt))
        prints.append(signed(total))
    bounds, sketch = parity_sketches(texts, grams, sizes, percent)
    new = np.zeros(rows, bool)
    for i, (doc, n, *key) in enumerate(zip(ids.to_pylist(), sizes.tolist(), prints[0].tolist(), prints[1].tolist(), strict=True)):
        if doc is not None and n and (n, *key) not in seen:
            new[i] = True
            seen.add((n, *key))
    columns = [ids, pa.array(sizes.astype(np.int64)), *[pa.array(p) for p in (*prints, *fixed_sketches(texts, grams, rows))]]
    return [*columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(sketch))], new


def _sets(width: int):
    def sets(batches):
        for batch in batches:
            for low, high in slices(batch.column(1)):
                texts, grams = shingle_sets(Words(batch.column(1).slice(low, high - low), lower=True), width)
                bounds = 8 * np.searchsorted(texts, np.arange(high - low + 1))
                buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(grams)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.Array.from_buffers(pa.binary(), high - low, buffers)], names=["id", "grams"])

    return sets


def _confirmed(percent: int):
    def confirmed(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return confirmed


def _links(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those stored pairs ``a < b`` whose whole sets are similar enough."""
    ids = store(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")
    sets = store(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets(width), "id long, grams binary"), "sets")
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b").join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a")
    links = store(both.select("a", "b", "x", "y").mapInArrow(_confirmed(percent), "a long, b long"), "links")
    discard(ids, sets)
    return links


def _spread(table: DataFrame, made: Column) -> DataFrame:
    """A stored table, dealt out evenly over more tasks where its files give tasks that would make more than ``ROWS_PER_TASK`` rows each of what ``made`` says."""
    rows = table.agg(F.sum(made.cast("long"))).first()[0] or 0
    tasks = ceil(rows / ROWS_PER_TASK)
    return table.repartition(tasks) if tasks > table.rdd.getNumPartitions() else table


def _star(marked: DataFrame, hubs: DataFrame, near: str) -> DataFrame:
    """Pairs ``a < b`` of every member with the ``HUBS`` bucket hubs it shares most buckets with.

    A set has as many buckets as it has keys, so the list of its hubs is bounded.
    """
    shared = marked.join(hubs, "key").where("rep != hub").where(near).groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("c"), F.max("hub_weight").alias("w"))
    ranked = F.sort_array(F.collect_list(F.struct("c", "w", (-F.col("hub")).alias("neg"))), asc=False)
    best = shared.groupBy("rep").agg(F.slice(ranked, 1, HUBS).alias("best")).select("rep", F.explode("best").alias("hub"))
    best = best.select("rep", (-F.col("hub.neg")).alias("hub"))
    return best.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def similar_groups(profiles: DataFrame, keys: Column, n_keys: Column, docs: DataFrame, width: int, percent: int, count_links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` (and ``n_links``) of the documents of ``profiles``, a stored table with ``FACTS`` and what ``keys`` is made of.

    ``keys`` is an array of ``n_keys`` bucket keys, empty where a copy of the same set already has them; ``docs`` are ``doc_id, text``. The profiles are discarded.

    * Equal sets are a class, known by its smallest id.
    * Keys held by several sets are found by an aggregation with map-side combining and joined back, so the bucket of a group that makes up a third of
      all rows can be split. A bucket's hub is the member with most company over all its buckets. Every set is compared with the few
      hubs it shares most buckets with, so a group of near copies costs that many comparisons a member.
    * Members of buckets that this leaves in several components are then compared across these components, or, to count links, all members of each bucket.
    * Sizes and parity sketches rule pairs out without loss, where they are made; whole shingle sets confirm the others.
    """
    wide = profiles
    profiles = store(wide.select(*[f.name for f in FACTS]), "facts_of_all")
    filled = profiles.where("n > 0 AND doc_id IS NOT NULL")
    classes = store(filled.groupBy(*KIND).agg(F.min("doc_id").alias("rep")), "classes")
    placed = store(filled.select("doc_id", *KIND).join(classes, KIND).select("doc_id", "n", "rep"), "placed")

    rows = _spread(wide, n_keys).select("doc_id", F.explode(keys).alias("key"))
    heads = store(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "heads")
    found = store(rows.join(heads, "key"), "found")
    discard(wide, heads)
    every = store(found.join(placed.select("doc_id", "rep").distinct(), "doc_id").select("key", "rep").distinct(), "every")
    discard(found)
    sizes = store(every.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "sizes")
    members = store(every.join(sizes, "key"), "members")
    discard(every, sizes)
    company = store(members.groupBy("rep").agg(F.sum("c").alias("weight")), "company")
    own = filled.join(company.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    facts = store(own.select(F.col("doc_id").alias("rep"), "n", *FIXED, "sketch").dropDuplicates(["rep", "n", *FIXED]), "facts")
    marked = store(members.select("key", "rep").join(facts.select("rep", "n", *FIXED), "rep").join(company, "rep"), "marked")
    discard(members, company)
    best = marked.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("hub"), "n", *FIXED)).alias("best"))
    own = {"hub": -F.col("best.hub"), "hub_weight": F.col("best.weight"), "n_hub": F.col("best.n")} | {f"{c}_hub": F.col(f"best.{c}") for c in FIXED}
    hubs = store(best.select("key", *[c.alias(n) for n, c in own.items()]), "hubs")
    most = lambda a, b: most_difference(f"n{a}", f"n{b}", percent)
    near = lambda a, b: f"{sizes_allow(f'n{a}', f'n{b}', percent)} AND {fixed_allow(a, b, most(a, b))}"
    alike = sketches_allow("sketch_a", "sketch_b", most("_a", "_b"))
    star = store(_star(marked, hubs, near("", "_hub")), "star")
    left, right = (facts.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab")
    likely = store(star.join(left, "a").join(right, "b").where(alike).select("a", "b").distinct(), "likely")
    links = _links(likely, docs, width, percent)
    # A document whose versions are in several classes ties these together.
    several = store(placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("hi")).where("a < hi").select("doc_id", "a"), "several")
    ties = store(placed.join(several, "doc_id").where("rep != a").select("a", F.col("rep").alias("b")).distinct(), "ties")
    groups = store(connected_components(links.union(ties)), "groups")

    # Members of one bucket that are still in different components may be linked all the same.
    parts = marked.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("g", F.coalesce("component", "rep"))
    parts = store(parts.select("key", "rep", "g"), "parts")
    discard(marked, hubs, likely, several)
    if not count_links:
        split = store(parts.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("key"), "split")
        rest = store(parts.join(split, "key", "left_semi"), "rest")
        discard(parts, split)
        parts = rest
    rest = store(parts.join(facts, "rep"), "rest")
    left, right = (rest.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "g", "n", *FIXED, "sketch")]) for s in "ab")
    apart = "rep_a < rep_b" if count_links else "rep_a < rep_b AND g_a != g_b"
    more = left.join(right, "key").where(f"{apart} AND {near('_a', '_b')} AND {alike}")
    more = store(more.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct().join(star, ["a", "b"], "left_anti"), "more")
    discard(parts, rest, star, facts)
    found = _links(more, docs, width, percent)
    discard(more)
    # What they join are components, few of which are left to be joined.
    label = groups.withColumnRenamed("component", "g")
    ends = found.join(label.withColumnRenamed("node", "a").withColumnRenamed("g", "g_a"), "a", "left").join(label.withColumnRenamed("node", "b").withColumnRenamed("g", "g_b"), "b", "left")
    ends = ends.select(F.coalesce("g_a", "a").alias("a"), F.coalesce("g_b", "b").alias("b"))
    joined = store(connected_components(ends), "joined").select(F.col("node").alias("g"), F.col("component").alias("whole"))
    whole = placed.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("g", F.coalesce("component", "rep")).join(joined, "g", "left")

    columns = [F.coalesce("whole", "g").alias("component_id")]
    if count_links:
        links = links.union(found).distinct()
        ends = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
        whole, columns = whole.join(store(ends, "ends"), "rep", "left"), [*columns, F.coalesce("links", F.lit(0).cast("long")).alias("n_links")]
    found = whole.select("doc_id", F.col("n").alias("n_shingles"), *columns)
    empty = profiles.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", "doc_id", *[F.lit(0).cast("long") for _ in columns[1:]])
    return found.union(empty)
