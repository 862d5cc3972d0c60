"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its letter n-grams (one to four letters, word ends marked).
Embeddings and weights are learned together by stochastic gradient descent on a bounded, labelled sample.
As both layers are linear, prediction multiplies n-gram counts by one folded matrix. A temperature makes
the probabilities honest, and those below a threshold, set so that accepted answers are right as often as
asked, are rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import crc_mod, numbered, pick

UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def subwords(text: str | None, buckets: int, letters: np.ndarray, longest: int = 4) -> np.ndarray:
    """Hash buckets of the letter n-grams of a text; empty if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[points] if len(points) else np.zeros(0, bool)
    if not is_letter.any():
        return np.zeros(0, np.int64)
    c = np.where(is_letter, points, 0).astype(np.uint64)
    c = np.concatenate([np.zeros(1, np.uint64), c, np.zeros(1, np.uint64)])
    c = c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]
    out, h = [], np.zeros(len(c), np.uint64)
    inner = np.ones(len(c), bool)           # no word end inside the n-gram so far
    for n in range(1, longest + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x100000001B3) + c[n - 1:n - 1 + m] + np.uint64(1)
        inner = inner[:m] if n < 3 else inner[:m] & (c[n - 2:n - 2 + m] > 0)
        use = inner & (c[:m] > 0) if n == 1 else inner
        x = (h[use] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((x >> np.uint64(40)) % np.uint64(buckets))
    return np.concatenate(out).astype(np.int64)


@dataclass
class LanguageModel:
    languages: list[str]
    matrix: np.ndarray                      # buckets x languages
    temperature: float = 1.0
    least: float = 0.0                      # answers below are rejected

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and whether it is rejected, of each text."""
        letters, buckets = _letters(), len(self.matrix)
        names, score = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            found = subwords(text, buckets, letters)
            if not len(found) or not self.languages:
                names.append(UNKNOWN)
                continue
            p = softmax(np.bincount(found, minlength=buckets) @ self.matrix / len(found) / self.temperature)
            names.append(self.languages[int(np.argmax(p))])
            score[i] = p.max()
        rejected = (score < self.least) | np.array([n == UNKNOWN for n in names], bool)
        return names, score, rejected


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(sample: list[tuple[int, np.ndarray, np.ndarray]], languages: int, buckets: int, width: int, epochs: int,
          rate: float, seed: int) -> np.ndarray:
    """The folded matrix. A sample row is the language, the buckets of a text, and their shares of its n-grams."""
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / width, 1 / width, (buckets, width))
    weights = np.zeros((width, languages))
    steps, total = 0, max(1, epochs * len(sample))
    for _ in range(epochs):
        for j in rng.permutation(len(sample)):
            language, at, share = sample[j]
            step = rate * (1 - steps / total)
            steps += 1
            hidden = share @ embedding[at]
            error = softmax(hidden @ weights)
            error[language] -= 1
            back = weights @ error
            weights -= step * np.outer(hidden, error)
            embedding[at] -= step * share[:, None] * back[None, :] * 50.0       # shares are small: n-grams by the hundred
    return embedding @ weights


def fit(docs: DataFrame, held_out: int | None = 2, per_language: int = 600, buckets: int = 1 << 14, width: int = 16,
        epochs: int = 12, rate: float = 0.5, precision: float = 0.95, seed: int = 5) -> LanguageModel:
    """Learns from text and lang of documents whose crc32(doc_id) modulo 4 is not ``held_out``.

    At most about ``per_language`` documents of each language are used, picked by hash; of these a third is kept
    aside to set the temperature and the rejection: the least probability from which on accepted answers are
    right with ``precision``. Null languages, null ids and texts without letters teach nothing.
    """
    docs = pick(docs, "doc_id", "text", "lang").where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    docs = docs.withColumn("fold", crc_mod(F.col("doc_id"), 4))
    docs = docs if held_out is None else docs.where(F.col("fold") != held_out)
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((1, 0)))
    chance = F.lit(0)
    for name in languages:
        chance = F.when(F.col("lang") == name, F.lit(int(min(1.0, per_language / counts[name]) * 1_000_000))).otherwise(chance)
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < chance).select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            found = [np.unique(subwords(t, buckets, letters), return_counts=True) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                 pa.array([(n / max(1, n.sum())).astype(np.float32).tobytes() for _, n in found], pa.binary())],
                names=["doc_id", "lang", "at", "share"])

    rows = picked.mapInArrow(run, "doc_id long, lang string, at binary, share binary").collect()
    sample, aside = [], []
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["lang"])):
        at = np.frombuffer(r["at"], np.int32)
        if len(at):
            last = zlib.crc32(f"aside:{r['doc_id']}".encode()) % 3 == 0
            (aside if last else sample).append((languages.index(r["lang"]), at, np.frombuffer(r["share"], np.float32).astype(float)))
    model = LanguageModel(languages, train(sample, len(languages), buckets, width, epochs, rate, seed))
    if aside:
        logits = np.array([share @ model.matrix[at] for _, at, share in aside])
        truth = np.array([language for language, _, _ in aside])
        model.temperature, model.least = calibrate(logits, truth, precision)
    return model


def calibrate(logits: np.ndarray, truth: np.ndarray, precision: float) -> tuple[float, float]:
    """The temperature of least log loss, and the least probability at which accepted answers are precise enough."""
    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()

    temperature = float(min(np.geomspace(0.05, 10, 60), key=loss))
    p = softmax(logits / temperature)
    sure, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-sure, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    if good[-1] or not good.any():
        return temperature, 0.0
    return temperature, float(sure[order][np.flatnonzero(good)[-1]])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected per row.

    A text that is null or has no letter is ``und`` with score 0, and rejected. Whole texts count. Repeated
    rows get equal answers; a null id is not held out; ties go to the first language by name. Without any labelled
    text all answers are ``und``. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, rejected = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = pick(docs, "doc_id", "text").withColumn("held_out", crc_mod(F.col("doc_id"), 4) == 2)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with all columns."""
    of = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~model.predict(batch.column(of).to_pylist())[2]))

    own = numbered(docs)
    return own.mapInArrow(run, own.schema).toDF(*docs.columns)
