"""Nearest neighbours by learned partitions: a neighbour graph is cut into balanced parts and a classifier routes to them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.sources.scratch import store

#: Vectors the partitions are learnt from, at most.
SAMPLE = 8_192
PARTS = 32
NEIGHBOURS = 16
#: Vectors and queries of one part that meet in one task, at most about.
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 2_048
#: Share of a sample's neighbours that the probed parts have to hold.
TARGET = 0.97


@dataclass
class Router:
    """A linear softmax classifier over parts, how many parts to probe, and the vectors in each part."""

    weights: np.ndarray
    offsets: np.ndarray
    probes: int
    counts: np.ndarray | None = None

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability."""
        return np.argsort(-(x @ self.weights + self.offsets), axis=1, kind="stable")

    def to_probe(self, x: np.ndarray, least: int) -> list[np.ndarray]:
        """The most probable parts of each query, more where those hold fewer than ``least`` vectors."""
        ranked = self.ranked(x)
        held = np.cumsum(self.counts[ranked], axis=1)
        enough = (held < least).sum(axis=1) + 1
        return [r[: max(self.probes, int(n))] for r, n in zip(ranked, enough, strict=True)]


def neighbour_lists(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows of largest inner product for each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), max(k, 0)), np.int64)
    for low in range(0, len(x) if k > 0 else 0, 1024):
        near = x[low : low + 1024] @ x.T
        near[np.arange(len(near)), np.arange(low, low + len(near))] = -np.inf
        out[low : low + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, slack: float = 1.05, sweeps: int = 25, seed: int = 1) -> np.ndarray:
    """A part for each row such that few graph edges are cut and no part has more than its even share times ``slack``.

    Rows start at the most similar of some random rows with room left; then, sweep by sweep, rows move to the part most of
    their neighbours (in either direction) are in, the largest gains first, while it has room.
    """
    n = len(x)
    room = int(np.ceil(n / parts * slack))
    rng = np.random.default_rng(seed)
    order = x @ x[rng.choice(n, parts, replace=n < parts)].T
    part, size = np.full(n, -1), np.zeros(parts, np.int64)
    for i in np.argsort(-order.max(axis=1), kind="stable"):
        for p in np.argsort(-order[i], kind="stable"):
            if size[p] < room:
                part[i], size[p] = p, size[p] + 1
                break
    heads, tails = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    rows = np.arange(n)
    for _ in range(sweeps):
        votes = np.zeros((n, parts))
        np.add.at(votes, (heads, part[tails]), 1)
        np.add.at(votes, (tails, part[heads]), 1)
        best = votes.argmax(axis=1)
        gain = votes[rows, best] - votes[rows, part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, part: np.ndarray, near: np.ndarray, parts: int, steps: int = 300) -> Router:
    """A softmax classifier whose targets are the parts a row's neighbours and the row itself are in."""
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near.ravel()]), 1)
    np.add.at(goal, (np.arange(len(x)), part), 1)
    goal /= goal.sum(axis=1, keepdims=True)
    scale = 1 / max(1e-12, float(np.sqrt((x**2).sum(axis=1).mean())))
    z = np.hstack([x * scale, np.ones((len(x), 1))])
    w = np.zeros((z.shape[1], parts))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        logits = z @ w
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = z.T @ (p - goal) / len(z) + 1e-5 * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Router(w[:-1] * scale, w[-1], parts)


def learn_router(x: np.ndarray, k: int, parts: int = PARTS, target: float = TARGET) -> Router:
    """Partition, classifier and the least number of probes that holds ``target`` of the sample's ``k`` neighbours."""
    if len(x) < 4 * parts:
        parts = max(1, len(x) // 64)
    if parts == 1 or not len(x):
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    near = neighbour_lists(x, NEIGHBOURS)
    router = train_router(x, balanced_parts(x, near, parts), near, parts)
    ranked = router.ranked(x)
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.broadcast_to(np.arange(parts), ranked.shape), axis=1)
    own, some = ranked[:, 0], np.arange(0, len(x), max(1, len(x) // 2_000))
    truth = neighbour_lists(x, k)[some]
    at = np.take_along_axis(place[some], own[truth], axis=1)
    held = np.array([(at < m).mean() for m in range(1, parts + 1)])
    router.probes = int(np.searchsorted(held, target) + 1) if held[-1] >= target else parts
    return router


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and one that isn't zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _route(router: Router, queries: bool, least: int):
    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            to = router.to_probe(x, least) if queries else list(router.ranked(x)[:, :1])
            rows = pa.array(np.repeat(np.arange(len(x)), [len(t) for t in to]))
            part = pa.array(np.concatenate(to).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), part], names=["id", "vector", "part"])

    return route


def _search(k: int):
    def search(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and vectors.num_rows:
            q, x = (_matrix(t.column("vector").combine_chunks()) for t in (queries, vectors))
            q_ids, x_ids = (t.column("id").to_numpy() for t in (queries, vectors))
            for low in range(0, len(q), 256):
                near = q[low : low + 256] @ x.T
                near[q_ids[low : low + 256, None] == x_ids] = -np.inf
                take = min(k, near.shape[1])
                bound = np.partition(near, near.shape[1] - take, axis=1)[:, near.shape[1] - take]
                # Sums in another order differ in the last bits: take what may tie, then add up each pair alike.
                rows, cols = np.nonzero((near >= (bound - 1e-9 * (1 + np.abs(bound)))[:, None]) & (near > -np.inf))
                score = (q[low + rows] * x[cols]).sum(axis=1)
                order = np.lexsort((x_ids[cols], -score, rows))
                rows, cols, score = rows[order], cols[order], score[order]
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
                best = rank < k
                out["query_id"].append(q_ids[low + rows[best]])
                out["vec_id"].append(x_ids[cols[best]])
                out["score"].append(score[best])
        kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
        return pa.table({c: np.concatenate([*v, np.zeros(0, kinds[c])]) for c, v in out.items()})

    return search


def nearest(df: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product found for each query, nearest first.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those of the query's id; ties go to the smaller id.

    * The index is learnt from at most ``SAMPLE`` vectors chosen by a hash of the id: their neighbour graph is cut into ``PARTS`` balanced parts,
      and a softmax classifier learns which parts a vector's neighbours are in. Every row is then indexed under its most
      probable part; a query probes as many as held ``TARGET`` of the neighbours within the sample, more if they hold too few rows.
    * Parts are cut into blocks of vectors and of queries by their counts, so that no task gets more than one block of each, however
      large a part is. Each block of queries meets each block of its parts; scores are added up in double precision.
    * Of equal vectors only the ``k + 1`` smallest ids can be among the nearest, so the others are left out of the blocks; this
      limit is applied before the shuffle. Queries are not left out.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without id and vectors of
    another length than most. Repeated rows count once; different vectors of one id are all candidates and all asked. Fewer candidates than ``k`` give fewer rows; an empty table gives none.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & F.col("id").isNotNull())
    common = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    result = "query_id long, vec_id long, score double"
    if common is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == common["n"])
    copies = Window.partitionBy("key").orderBy("id")
    # Repeats of an id go first, where they are, so that the limit on copies counts ids.
    distinct = rows.withColumn("key", F.sha2(F.col("vector").cast("string"), 256)).dropDuplicates(["key", "id"])
    distinct = store(distinct.withColumn("copy", F.row_number().over(copies)).where(f"copy <= {k + 1}"), "distinct")
    sample = distinct.where("copy = 1").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()
    router = learn_router(np.array([r[0] for r in sample], np.float64), k)

    kind = "id long, vector array<double>, part int"
    indexed = store(distinct.select("id", "vector").mapInArrow(_route(router, False, 0), kind), "indexed")
    counts = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}  # PARTS rows at most
    router.counts = np.array([counts.get(p, 0) for p in range(len(router.offsets))])
    queries = rows.where(F.col("id") % every == 0)
    routed = store(queries.mapInArrow(_route(router, True, 2 * k + 2), kind), "queries")
    asked = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}

    spark = df.sparkSession
    blocks = [(p, max(1, -(-counts.get(p, 0) // BLOCK_VECTORS)), max(1, -(-asked.get(p, 0) // BLOCK_QUERIES))) for p in range(len(router.offsets))]
    blocks = F.broadcast(spark.createDataFrame(blocks, "part int, v_blocks int, q_blocks int"))  # one row a part
    v = indexed.join(blocks, "part").withColumn("v", F.expr("pmod(xxhash64(id), v_blocks)")).withColumn("q", F.explode(F.expr("sequence(0L, q_blocks - 1L)")))
    q = routed.join(blocks, "part").withColumn("q", F.expr("pmod(xxhash64(id, vector), q_blocks)")).withColumn("v", F.explode(F.expr("sequence(0L, v_blocks - 1L)")))
    keys = ["part", "v", "q"]
    pairs = q.select(*keys, "id", "vector").groupBy(*keys).cogroup(v.select(*keys, "id", "vector").groupBy(*keys)).applyInArrow(_search(k), result)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = pairs.distinct().withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")
    return found.select("query_id", "rank", "vec_id", "score")
