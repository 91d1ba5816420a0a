"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Index: k-means centroids fitted on a bounded sample; every vector goes to the list of its nearest centroid.
The number of lists a query probes is calibrated: for a bounded sample of vectors the true neighbours are
found by a full scan, and the smallest number of lists that holds ``target`` of them is taken.

Search: queries and list members meet by list.  A long list is cut into chunks and its queries into
batches, so no task takes a whole hot list.  In a task the vectors are rotated by a random orthogonal
matrix and read in column blocks.  After d of D rotated dimensions the partial distance, scaled by D / d,
estimates the full one; a candidate whose estimate exceeds the query's current k-th distance by more than
a factor 1 + eps / sqrt(d) is rejected with the confidence that eps sets.  The first k-th distance is exact,
and every test allows for rounding, so copies of a query stay.  Survivors get the exact distance on the
original vectors in double precision.

Defined cases: vectors that are NULL, all zero, of another length than most, or hold NULL or non-finite
components take no part, nor do rows without an id; rows that repeat a vec_id count as one neighbour;
equal distances go to the smaller id; a query whose probed lists hold too few searches all lists; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadscope.llm.common import written

FOUND = "query_id long, vec_id long, score double"
ROUNDING = 1e-12          # of the squared norms: above the rounding of any distance between rotated vectors
PAIR_VALUES = 1 << 22     # components of the pairs that are measured at a time


@dataclass
class Lists:
    """Centroids and the calibrated number of lists to probe."""
    centroids: np.ndarray
    probes: int
    dims: int
    sample_recall: float


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, vector) of the rows that take part, and their length."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fine)
                      & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = sizes[0]["n"] if sizes else 0
    return rows.where(F.size("vector") == dims), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _sampled(rows: DataFrame, share: float, salt: int) -> DataFrame:
    return rows if share >= 1 else rows.where(
        F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1 << 30)) < max(1, int(share * (1 << 30))))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def _nearest(points: np.ndarray, centroids: np.ndarray, block: int = 4096) -> np.ndarray:
    return np.concatenate([np.argmin(_squares(points[i:i + block], centroids), axis=1)
                           for i in range(0, len(points), block)]) if len(points) else np.zeros(0, np.int64)


def k_means(points: np.ndarray, count: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(points))
    # copies of a point would make equal centroids, among which rounding picks the list
    centroids = points[order[np.sort(np.unique(points[order], axis=0, return_index=True)[1])[:count]]]
    count = len(centroids)
    for _ in range(rounds):
        own = _nearest(points, centroids)
        size = np.bincount(own, minlength=count)
        total = np.stack([np.bincount(own, weights=points[:, d], minlength=count) for d in range(points.shape[1])], axis=1)
        centroids = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centroids)
    return centroids


def _true_neighbours(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, dims: int) -> list[np.ndarray]:
    """The k nearest vectors of a bounded set of queries over all rows (each task keeps k of its own)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            points = _matrix(batch.column(1), dims)
            away = _squares(queries, points)
            away[ids[:, None] == own[None, :]] = np.inf
            top = np.argsort(away, axis=1, kind="stable")[:, :k]
            query = np.repeat(np.arange(len(ids)), top.shape[1])
            score = np.take_along_axis(away, top, axis=1).ravel()
            ok = np.isfinite(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[ok]), pa.array(score[ok]), batch.column(1).take(pa.array(top.ravel()[ok]))],
                names=["query", "score", "vector"])

    best = Window.partitionBy("query").orderBy("score")
    found = (rows.mapInArrow(run, "query long, score double, vector array<double>")
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "vector").collect())
    return [np.array([r["vector"] for r in found if r["query"] == q]).reshape(-1, dims) for q in range(len(ids))]


def fit(rows: DataFrame, dims: int, k: int = 10, target: float = 0.97, max_lists: int = 4096, per_list: int = 20,
        sample_queries: int = 128) -> Lists:
    """Centroids from at most about max_lists * per_list sampled vectors, probes from ``sample_queries``."""
    n = rows.count()
    count = max(1, min(max_lists, math.isqrt(n)))
    wanted = count * per_list
    sample = np.array([r["vector"] for r in _sampled(rows, wanted / max(n, 1), 1).orderBy("vec_id").collect()], np.float64)
    sample = sample.reshape(-1, dims)
    count = max(1, min(count, len(sample)))
    centroids = k_means(sample, count) if len(sample) else np.zeros((1, dims))
    count = len(centroids)
    asked = _sampled(rows, sample_queries / max(n, 1), 2).orderBy("vec_id").collect()
    if not asked:
        return Lists(centroids, count, dims, 1.0)
    ids = np.array([r["vec_id"] for r in asked], np.int64)
    queries = np.array([r["vector"] for r in asked], np.float64)
    ranks = []
    for q, true in zip(queries, _true_neighbours(rows, ids, queries, k, dims)):
        order = np.argsort(_squares(q[None, :], centroids)[0], kind="stable")
        place = np.empty(count, np.int64)
        place[order] = np.arange(count)
        ranks += place[_nearest(true, centroids)].tolist()
    ranks = np.sort(np.array(ranks, np.int64))
    if not len(ranks):
        return Lists(centroids, count, dims, 1.0)
    probes = int(ranks[min(len(ranks) - 1, math.ceil(target * len(ranks)) - 1)]) + 1
    return Lists(centroids, probes, dims, float((ranks < probes).mean()))


def build(rows: DataFrame, lists: Lists) -> DataFrame:
    """The written index: (list, vec_id, vector) of every row."""
    centroids = rows.sparkSession.sparkContext.broadcast(lists.centroids)
    dims = lists.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _nearest(_matrix(batch.column(1), dims), centroids.value)
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column(0), batch.column(1)],
                                             names=["list", "vec_id", "vector"])

    return written(rows.mapInArrow(run, "list long, vec_id long, vector array<double>"), "lists")


def probed(queries: DataFrame, lists: Lists, probes: int) -> DataFrame:
    """(list, query_id, query) for the nearest lists of each query."""
    centroids = queries.sparkSession.sparkContext.broadcast(lists.centroids)
    dims = lists.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                away = _squares(_matrix(part.column(1), dims), centroids.value)
                order = np.argsort(away, axis=1, kind="stable")[:, :probes]
                take = pa.array(np.repeat(np.arange(part.num_rows), order.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(order.ravel()), part.column(0).take(take), part.column(1).take(take)],
                                                 names=["list", "query_id", "query"])

    return queries.mapInArrow(run, "list long, query_id long, query array<double>")


def rotation(dims: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def scan(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, eps: float, block: int,
         turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, point row, distance) of at most k nearest points for each query."""
    dims = queries.shape[1]
    q, p = queries @ turn.T, points @ turn.T
    same = query_ids[:, None] == ids[None, :]
    # the bound to start from: the exact distance of k of the first points, which have k different ids
    lead = np.sort(np.unique(ids, return_index=True)[1])[:4 * k]
    first = _squares(q, p[lead])
    first[same[:, lead]] = np.inf
    bound = np.full(len(q), np.inf)
    if len(lead) >= k:
        near = np.argsort(first, axis=1, kind="stable")[:, :k]
        bound = np.zeros(len(q))
        for rank in range(k):
            diff = queries - points[lead[near[:, rank]]]
            bound = np.maximum(bound, (diff * diff).sum(axis=1))
        bound[np.isinf(np.take_along_axis(first, near, axis=1)).any(axis=1)] = np.inf
    # partial distances are off by rounding, of the squared norms' size; a bound near 0 must not reject by that
    noise_q, noise_p = ROUNDING * (queries * queries).sum(axis=1), ROUNDING * (points * points).sum(axis=1)

    def keeps(away: np.ndarray, noise: np.ndarray, limit: np.ndarray, at: int) -> np.ndarray:
        if at < dims and math.isinf(eps):
            return np.isfinite(away)
        slack = (1 + eps / math.sqrt(at)) ** 2 if at < dims else 1 + 1e-9
        return np.isfinite(away) & ((away - noise) * (dims / at) <= limit * slack)

    start = min(block, dims)
    part = _squares(q[:, :start], p[:, :start])
    part[same] = np.inf
    rows, cols = np.nonzero(keeps(part, noise_q[:, None] + noise_p[None, :], bound[:, None], start))
    kept = [(rows[:0], cols[:0], np.zeros(0))]
    step = max(1, PAIR_VALUES // dims)
    for i in range(0, len(rows), step):      # copies of a query all get here, so the pairs go in pieces
        row, col, at = rows[i:i + step], cols[i:i + step], start
        away = part[row, col]
        while at < dims:
            end = min(at + block, dims)
            diff = q[row, at:end] - p[col, at:end]
            away = away + (diff * diff).sum(axis=1)
            at = end
            on = keeps(away, noise_q[row] + noise_p[col], bound[row], at)
            row, col, away = row[on], col[on], away[on]
        diff = queries[row] - points[col]
        kept.append((row, col, np.sqrt((diff * diff).sum(axis=1))))
    row, col, score = (np.concatenate(x) for x in zip(*kept))
    # rows that repeat an id count once, at their smallest distance
    order = np.lexsort((score, ids[col], row))
    row, col, score = row[order], col[order], score[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (ids[col[1:]] != ids[col[:-1]])
    row, col, score = row[new], col[new], score[new]
    order = np.lexsort((ids[col], score, row))
    row, col, score = row[order], col[order], score[order]
    top = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[top], col[top], score[top]


def _search(index: DataFrame, queries: DataFrame, lists: Lists, probes: int, k: int, eps: float, block: int,
            chunk: int, batch: int) -> DataFrame:
    asked = probed(queries, lists, probes)
    # both sizes have at most one row per list
    members = F.broadcast(index.groupBy("list").agg(F.ceil(F.count("*") / chunk).cast("long").alias("chunks")))
    callers = F.broadcast(asked.groupBy("list").agg(F.ceil(F.count("*") / batch).cast("long").alias("batches")))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = (asked.join(members, "list").join(callers, "list")
            .withColumn("batch", F.pmod(F.xxhash64("query_id"), F.col("batches"))).withColumn("chunk", spread("chunks"))
            .select("list", "chunk", "batch", "query_id", "query"))
    right = (index.join(members, "list").join(callers, "list")
             .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks"))).withColumn("batch", spread("batches"))
             .select("list", "chunk", "batch", "vec_id", "vector"))
    dims, turn = lists.dims, rotation(lists.dims)

    def meet(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        parts = []
        if ours.num_rows and theirs.num_rows:
            ids = theirs.column("vec_id").combine_chunks().to_numpy()
            points = _matrix(theirs.column("vector").combine_chunks(), dims)
            order = np.argsort(ids, kind="stable")
            ids, points = ids[order], points[order]
            step = max(1, 2_000_000 // len(ids))
            for at in range(0, ours.num_rows, step):
                some = ours.slice(at, step)
                query_ids = some.column("query_id").combine_chunks().to_numpy()
                row, col, score = scan(_matrix(some.column("query").combine_chunks(), dims), query_ids, points, ids, k, eps,
                                       block, turn)
                parts.append(pa.Table.from_arrays([pa.array(query_ids[row]), pa.array(ids[col]), pa.array(score)],
                                                  names=["query_id", "vec_id", "score"]))
        empty = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()
        return pa.concat_tables([empty, *parts])

    keys = ["list", "chunk", "batch"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def neighbours(vectors: DataFrame, is_query, k: int = 10, target: float = 0.97, eps: float = 2.1, block: int = 16,
               id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = 20_000, batch: int = 5_000) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors found for each row where ``is_query``.

    ``is_query`` is a condition on ``vec_id`` (SQL text or Column).  All candidates come back when there are fewer than k.
    """
    rows, dims = usable(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = written(rows, "vectors")
    lists = fit(rows, dims, k, target)
    index = build(rows, lists)
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    out = written(_search(index, queries, lists, lists.probes, k, eps, block, chunk, batch), "found")
    full = out.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = queries.join(full, "vec_id", "left_anti")
    if lists.probes < len(lists.centroids) and not short.isEmpty():
        more = _search(index, short, lists, len(lists.centroids), k, float("inf"), block, chunk, batch)
        out = out.join(full, out["query_id"] == full["vec_id"], "left_semi").unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
