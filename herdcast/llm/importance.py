"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams (one and two words), one of target text and one of all
text, give every document the log of their ratio. Documents are sampled without replacement, with
that weight, as those with the largest log weight plus Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import WordHash, materialise, mix64, numbered, pick, pieces_of, words_bytes


@dataclass
class Sampler:
    """``log_ratio`` by bucket; documents whose key reaches ``least`` are sampled."""
    log_ratio: np.ndarray
    passage: float
    seed: int
    least: float = -np.inf

    def scores(self, ids: list, texts: list, hashes: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n-grams, log weight and noisy key of some documents."""
        found = [ngrams(t, len(self.log_ratio), hashes) for t in texts]
        n = np.array([len(f) for f in found], np.int64)
        weight = np.array([self.log_ratio[f].sum() / max(1, len(f)) for f in found], float) * self.passage
        return n, weight, weight + gumbel(ids, self.seed)


def ngrams(text: str | None, buckets: int, hashes: WordHash) -> np.ndarray:
    h = hashes.array(words_bytes(text))
    if len(h) > 1:
        h = np.concatenate([h, mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])])
    return (h % np.uint64(buckets)).astype(np.int64)


def gumbel(ids: list, seed: int) -> np.ndarray:
    """Gumbel noise from a hash of each id (a missing id hashes as -1)."""
    x = np.array([-1 if i is None else i for i in ids], np.int64).view(np.uint64)
    u = (mix64(mix64(x) + np.uint64(seed)) >> np.uint64(11)).astype(float)
    return -np.log(-np.log((u + 0.5) / 2.0 ** 53))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 20_000, buckets: int = 1 << 15, passage: float = 200.0,
        slack: float = 0.02, keep: float | None = None, seed: int = 11) -> Sampler:
    """Models and threshold for ``docs``.

    The target is good text: labels with quality 1 that are not toxic, ``labelled`` of them at most (by hash);
    the other model counts every document. Weights are of a passage of ``passage`` n-grams, so that
    long documents are not judged by their length. Sampled are the share ``keep`` of the documents, or
    else the share of good labels plus ``slack``. Without good labels everything is sampled.
    """
    docs = pick(docs, "doc_id", "text")
    labels = pick(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()
    target = {r["doc_id"] for r in good.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(labelled).collect()}
    share = labels.agg(F.avg((F.col("quality") == 1).cast("double")).alias("s")).first()["s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHash(), np.zeros((2, buckets), np.int64)
        for batch in pieces_of(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.bincount(ngrams(text, buckets, hashes), minlength=buckets)
                counts[0] += own
                if doc in target:
                    counts[1] += own
        for kind in (0, 1):
            used = np.flatnonzero(counts[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), kind, np.int32)), pa.array(used.astype(np.int32)),
                                              pa.array(counts[kind][used])], names=["kind", "bucket", "n"])

    sums = np.zeros((2, buckets))
    for r in docs.mapInArrow(run, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect():
        sums[r["kind"], r["bucket"]] = r["n"]
    log_ratio = np.zeros(buckets)
    if sums[1].any():
        log_ratio = np.log((sums[1] + 1) / (sums[1].sum() + buckets)) - np.log((sums[0] + 1) / (sums[0].sum() + buckets))
    sampler = Sampler(log_ratio, passage, seed)
    if sums[1].any():
        scored = materialise(score(docs, sampler).select("key"), "importance-keys")
        rows = scored.count()
        sampler.least = kth_largest(scored, "key", int(np.ceil(rows * min(1.0, share + slack if keep is None else keep))))
    return sampler


def kth_largest(df: DataFrame, column: str, k: int, parts: int = 4096) -> float:
    """The k-th largest value of a column of doubles, by histograms over an ever narrower range."""
    low, high = (float(x) if x is not None else 0.0 for x in df.agg(F.min(column), F.max(column)).first())
    if k <= 0:
        return float("inf")
    above, rows = 0, df
    while low < high:
        width = (high - low) / parts
        part = F.least(F.lit(parts - 1), F.floor((F.col(column) - low) / width)).cast("int")
        found = rows.groupBy(part.alias("p")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for r in sorted(found.collect(), key=lambda r: -r["p"]):
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]
        else:
            return low
        rows = rows.where(F.col(column).between(low, high))
    return low


def score(docs: DataFrame, sampler: Sampler) -> DataFrame:
    """doc_id, n_ngrams, log_weight, key and kept per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in pieces_of(batches):
            ids = batch.column(0).to_pylist()
            n, weight, key = sampler.scores(ids, batch.column(1).to_pylist(), hashes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(weight), pa.array(key), pa.array(key >= sampler.least)],
                                             names=["doc_id", "n_ngrams", "log_weight", "key", "kept"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_ngrams long, log_weight double, key double, kept boolean")


def resample(docs: DataFrame, sampler: Sampler) -> DataFrame:
    """The sampled rows of ``docs``, with all columns."""
    at, of = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in pieces_of(batches):
            _, _, key = sampler.scores(batch.column(at).to_pylist(), batch.column(of).to_pylist(), hashes)
            yield batch.filter(pa.array(key >= sampler.least))

    own = numbered(docs)
    return own.mapInArrow(run, own.schema).toDF(*docs.columns)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``score`` under the sampler that ``fit`` finds for these documents and labels.

    Null and empty texts have no n-grams and weight 0, like text as common in either model. Equal rows get
    equal keys and share one verdict; a tie with the last sampled key is sampled. A null id hashes as -1 and
    is never a target. Labels of unknown documents, null labels and other columns are ignored.
    """
    return score(docs, fit(docs, labels, **options))
