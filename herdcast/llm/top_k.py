"""Exact top-k search by inner product, with vectors grouped by length.

Candidates are read in chunks, sorted by length and cut into buckets of similar length. For a query and a
bucket, the score still needed and the bucket's longest vector give the least cosine a hit must have. Above one,
the bucket and all shorter ones are skipped. A high one leaves few vectors by their coordinates (a unit vector
near the query's must be near it on each axis), a low one those that are long enough. What is left is
scored exactly. Queries come in blocks of bounded size, and start from what the longest vectors reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdcast.llm.common import materialise, pick

SAFE = 2.0 ** 52


def scaled(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """vec_id and the whole-number components floor(factor * x), for vectors whose components are all finite."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (pick(vectors, "vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite)
            .select("vec_id", F.transform(x, lambda v: F.floor(v * factor).cast("double")).alias("v")))


def matrix(rows: list, width: int) -> np.ndarray:
    """Rows of numbers, shorter ones filled with zeros."""
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, kept within a long."""
    if not len(queries) or not len(vectors):
        return np.zeros((len(queries), len(vectors)), np.int64)
    if np.abs(queries).sum(axis=1).max() * np.abs(vectors).max() < SAFE:
        return (queries @ vectors.T).astype(np.int64)
    limit = 2 ** 63 - 1
    exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in v] for v in vectors], object).T
    return np.clip(exact, -limit, limit).astype(np.int64)


class Searcher:
    """Best hits so far of a block of queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.queries, self.k = ids, queries, k
        self.lengths = np.sqrt((queries ** 2).sum(axis=1))
        self.need = np.full(len(ids), -np.inf) if floor is None else floor.astype(float).copy()
        self.hits: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.axes = np.argsort(-np.abs(queries), axis=1, kind="stable")[:, :3] if queries.size else np.zeros((len(ids), 0), int)

    def _keep(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        use = (scores >= self.need[q]) & (ids != self.ids[q])
        if not use.any():
            return
        ids, scores = np.concatenate([self.hits[q][0], ids[use]]), np.concatenate([self.hits[q][1], scores[use]])
        best = np.lexsort((ids, -scores))[:self.k]
        self.hits[q] = ids[best], scores[best]
        if len(best) == self.k:
            self.need[q] = max(self.need[q], scores[best[-1]])

    def scan(self, ids: np.ndarray, vectors: np.ndarray, ratio: float = 0.9, steep: float = 0.6) -> None:
        """Looks at a chunk of candidates."""
        lengths = np.sqrt((vectors ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        ids, vectors, lengths = ids[order], vectors[order], lengths[order]
        unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        active = np.arange(len(self.ids))
        at = 0
        while at < len(ids) and len(active):
            top = lengths[at]
            end = max(at + 1, int(np.searchsorted(-lengths, -ratio * top, side="right")))
            reach = self.lengths[active] * top
            cosine = np.where(self.need[active] > 0, self.need[active] / np.maximum(reach, 1e-300), -1.0) - 1e-9
            # a zero reach scores 0: hopeless only if more is needed
            active, cosine = active[cosine <= 1], cosine[cosine <= 1]
            flat = active[cosine < steep]
            if len(flat):                                # by length: the whole bucket, or its long part
                scores = products(self.queries[flat], vectors[at:end])
                for row, q in enumerate(flat):
                    self._keep(q, ids[at:end], scores[row])
            for q, t in zip(active[cosine >= steep], cosine[cosine >= steep], strict=True):
                need = self.need[q] / max(self.lengths[q], 1e-300)
                stop = at + int(np.searchsorted(-lengths[at:end], -(need - 1e-6 * abs(need)), side="right"))
                near = np.ones(max(0, stop - at), bool)
                direction = self.queries[q] / self.lengths[q]
                for axis in self.axes[q]:
                    d = direction[axis]
                    spread = np.sqrt(max(0.0, (1 - min(1.0, t) ** 2) * (1 - d * d))) + 1e-6
                    low = d * t - spread if d * t - spread > -1 and not (d < 0 and -d > t) else -2.0
                    high = d * t + spread if not (d > 0 and d > t) else 2.0
                    own = unit[at:stop, axis]
                    near &= (own >= low) & (own <= high)
                some = at + np.flatnonzero(near)
                if len(some):
                    self._keep(q, ids[some], products(self.queries[q:q + 1], vectors[some])[0])
            at = end


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, block: int = 4096, chunk: int = 8192, seeds: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best partners of every row whose vec_id is divisible by ``every``.

    Ties go to the smaller vec_id; with fewer partners, all are given. Rows without id, without vector,
    or with a null or non-finite component take no part; vectors of different width are compared as if filled with
    zeros; an id that comes twice is one query (its least vector) and two candidates. Scores beyond a long are clipped.
    ``block`` queries are handled at a time, ``chunk`` candidates are held at a time, and the ``seeds`` longest
    vectors give the first bounds; none of them changes the result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    held = materialise(scaled(vectors), "vectors")
    width = held.agg(F.max(F.size("v"))).first()[0] or 1
    asked = held.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = materialise(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-asked.count() // block))))), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest = held.select("vec_id", "v", square.alias("s")).orderBy(F.desc("s"), "vec_id").limit(seeds).collect()
    seed_ids, seed_rows = np.array([r["vec_id"] for r in longest], np.int64), matrix([r["v"] for r in longest], width)
    out = None
    for (number,) in sorted(asked.select("block").distinct().collect()):
        own = asked.where(F.col("block") == number).collect()
        ids, queries = np.array([r["vec_id"] for r in own], np.int64), matrix([r["v"] for r in own], width)
        first = Searcher(ids, queries, k)
        first.scan(seed_ids, seed_rows)
        shared = spark.sparkContext.broadcast((ids, queries, first.need))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, queries, floor = shared.value
            searcher = Searcher(ids, queries, k, floor)
            for batch in batches:
                for at in range(0, batch.num_rows, chunk):
                    part = batch.slice(at, chunk)
                    searcher.scan(part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1).to_pylist(), width))
            n = [len(h[0]) for h in searcher.hits]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, n)), pa.array(np.concatenate([h[0] for h in searcher.hits])),
                 pa.array(np.concatenate([h[1] for h in searcher.hits]))], names=["query_id", "vec_id", "score"])

        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = held.mapInArrow(run, "query_id long, vec_id long, score long").withColumn("rank", F.row_number().over(best))
        found = materialise(found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "hits")
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out
