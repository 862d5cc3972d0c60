"""Language-model scoring by online logistic context mixing.

All training documents are counted into a vocabulary. The bit predictors (bit_model) count over that
vocabulary, weighted by each word's count, leaving out one fold of the training documents; on that fold
the mixing weights are learned online, one partition at a time and then averaged, and after them the adaptive
map that refines the mixed probability. Then the predictors are counted once more, over all training
documents, and words are coded with those. Contexts reach over the space before a word, but only its first two
bytes see the word before (see bit_model). So a document's bits are coded as those of its words' starts, each with the
two bytes before the space, and as those of the rest of its words; each distinct start and each distinct rest is coded
once, and documents add up what theirs cost, and the cost of their kind. Starts are counted like
words, in the same table, with a space in front, which no word has. The vocabulary is
sorted and cut into slices, in which the words under a prefix are neighbours, so the counts of all prefixes of all words
are exact sums within a slice; only what reaches over a slice's ends is added up by the driver. The costs of frequent words (a
bounded list) are kept by the workers; the others are joined, and as they are rare no key is hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import batched, compress, groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.llm import bit_model as bm
from herdcast.llm.common import columns_of, crc_mod, lowered, materialise, pick, pieces_of

END = b"\n"
HELD, MIXING_FOLD, FOLDS = 2, 6, 7
CHUNK = 12
STARTS = "starts"


@dataclass
class Slice:
    """A run of the vocabulary in order of kind and coded bytes (a word and its terminator)."""
    id: int
    coded: list[bytes]
    kinds: np.ndarray
    counts: dict[str, np.ndarray]                       # a, b, h
    before: np.ndarray | None = None                    # of starts: the two bytes before the space

    def blocks(self, prefix: np.ndarray | None = None, only: np.ndarray | None = None, size: int = 40_000):
        """(place, bytes) of words, with their prefix counts, in groups of ``size`` bytes, so that their bit arrays stay small."""
        lengths = np.fromiter(map(len, self.coded), np.int64, len(self.coded))
        starts = np.cumsum(lengths) - lengths
        chosen = np.arange(len(lengths)) if only is None else np.flatnonzero(only)
        group = np.cumsum(lengths[chosen]) // size
        for at in np.split(chosen, np.flatnonzero(np.diff(group)) + 1) if len(chosen) else ():
            own = None
            if prefix is not None:
                bits = lengths[at] * 8
                own = prefix[:, np.repeat(starts[at] * 8 - (np.cumsum(bits) - bits), bits) + np.arange(bits.sum())]
            yield at, [self.coded[i] for i in at], own


    def bits(self, at: np.ndarray, coded: list[bytes], low_bits: int) -> tuple[bm.Nodes, bm.Bits]:
        """Of some of the starts, or of some of the words without their starts."""
        nodes, before = self.nodes(at, coded)
        return nodes, bm.bits_of_coded(coded, self.kinds[at], low_bits, False, nodes, before)

    def nodes(self, at: np.ndarray, coded: list[bytes]) -> tuple[bm.Nodes, np.ndarray | None]:
        if self.before is None:
            return bm.Nodes.of(coded, self.kinds[at]).beyond(bm.HEAD), None
        before = self.before[at]
        return bm.Nodes.of(coded, self.kinds[at] << 16 | before[:, 0] << 8 | before[:, 1]), before

    def counted(self, columns: str, beyond):
        """A function that gives the prefix counts, by ``columns``, of the nodes of some of the words."""
        if self.before is not None:
            return lambda at, some: bm.start_counts(some, self.kinds[at], beyond[STARTS])
        nodes = bm.Nodes.of(self.coded, self.kinds)
        counts, starts = bm.node_counts(nodes, _weight(self, columns), beyond[self.id]), np.flatnonzero(nodes.place == 0)

        def of(at: np.ndarray, some: bm.Nodes) -> np.ndarray:
            return counts[:, nodes.node[(starts[at][some.word] + some.place)[some.first]]].reshape(2, -1)
        return of


def _slices(batches) -> Iterator[Slice]:
    for batch in batches:
        for r in batch.to_pylist():
            lengths = np.frombuffer(r["lengths"], np.int64)
            ends = np.cumsum(lengths)
            coded = [r["words"][e - n:e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            s = Slice(r["id"], coded, np.frombuffer(r["kinds"], np.int64), {c: np.frombuffer(r[c], np.int64) for c in "abh"})
            if r.get("starts"):
                s.before = np.frombuffer(b"".join(w[:2] for w in coded), np.uint8).reshape(-1, 2).astype(np.int64)
                s.id, s.coded = -1 - s.id, [w[2:] for w in coded]
            yield s


def sliced(vocab: DataFrame, words: int = 50_000, size: int = 500_000) -> DataFrame:
    """The vocabulary in order of kind and coded bytes, a row for each run of some words, with its first and last. A start
    is coded as the two bytes before its space and its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, cut, held, held_bytes = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal cut, held, held_bytes
            kinds, coded, *counts = zip(*held, strict=True)
            packed = lambda x: np.asarray(x, np.int64).tobytes()
            row = {"id": (task << 32) + cut, "words": b"".join(coded), "lengths": packed([len(w) for w in coded]), "kinds": packed(kinds),
                   **{n: packed(c) for n, c in zip("abh", counts, strict=True)},
                   "kind0": kinds[0], "word0": coded[0], "kind1": kinds[-1], "word1": coded[-1]}
            cut, held, held_bytes = cut + 1, [], 0
            return pa.RecordBatch.from_pylist([row], schema=out)

        for columns in columns_of(pieces_of(batches), ("kind", "coded", "a", "b", "h")):
            for row in zip(*columns, strict=True):
                held.append(row)
                held_bytes += len(row[1])
                if len(held) >= words or held_bytes >= size:
                    yield flush()
        if held:
            yield flush()

    long, raw = pa.int64(), pa.binary()
    out = pa.schema([("id", long), ("words", raw), ("lengths", raw), ("kinds", raw), ("a", raw), ("b", raw), ("h", raw),
                     ("kind0", long), ("word0", raw), ("kind1", long), ("word1", raw)])
    coded = (F.when(F.col("word") == F.lit(END), F.col("word")).when(~F.expr(IS_START), F.concat("word", F.lit(b" ")))
             .when(F.expr("substring(word, 4, 1)") == F.lit(END), F.expr("substring(word, 2, 3)")).otherwise(F.expr("substring(word, 2)")))
    key = F.concat(F.unhex(F.lpad(F.hex("kind"), 2, "0")), coded)        # in the same order, and its first bytes decide most comparisons
    return (vocab.select("kind", key.alias("key"), "a", "b", "h").repartitionByRange("key").sortWithinPartitions("key")
            .select("kind", F.expr("substring(key, 2)").alias("coded"), "a", "b", "h")
            .mapInArrow(run, "id long, words binary, lengths binary, kinds binary, a binary, b binary, h binary, "
                             "kind0 long, word0 binary, kind1 long, word1 binary"))


def slice_ends(slices: DataFrame) -> dict[int, tuple[int, int, int]]:
    """By slice, in order: leading bits shared with the slice before, of its own first and last word, and with the slice after."""
    rows = slices.select("id", "kind0", "word0", "kind1", "word1").orderBy("id").collect()

    def shared(kind, word, kind_, word_):
        if kind != kind_:
            return -1
        return len(word) * 8 - 1 if word == word_ else bm.lcp_bits(bytes(word), bytes(word_))

    own = [shared(r["kind0"], r["word0"], r["kind1"], r["word1"]) for r in rows]
    links = [-1, *[shared(x["kind1"], x["word1"], y["kind0"], y["word0"]) for x, y in zip(rows, rows[1:], strict=False)], -1]
    return {r["id"]: (links[i], own[i], links[i + 1]) for i, r in enumerate(rows)}


def beyond_slices(slices: DataFrame, ends: dict[int, tuple[int, int, int]], columns: str) -> dict:
    """What the other slices add to the prefixes that reach over a slice's ends; these few are summed by the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches):
            before, _, after = ends[s.id]
            first, last = bm.end_paths(s.coded, s.kinds, _weight(s, columns), before, after)
            yield pa.RecordBatch.from_pydict({"id": [s.id], "first": [first.tobytes()], "last": [last.tobytes()]})
    got = {r["id"]: tuple(np.frombuffer(r[c]).reshape(2, -1) for c in ("first", "last"))
           for r in slices.mapInArrow(run, "id long, first binary, last binary").collect()}
    return dict(zip(ends, bm.beyond_ends(list(ends.values()), [got[i] for i in ends]), strict=True)) if ends else {}


def _weight(s: Slice, columns: str) -> np.ndarray:
    return sum(s.counts[c] for c in columns).astype(float)


#: Of a row of the vocabulary, in SQL.
IS_START = "substring(word, 1, 1) = X'20'"


def starts_of(texts: list[list[bytes]]) -> np.ndarray:
    """The start of every token of some texts, given as their tokens, as one number: the two bytes before the space in front of it,
    spaces where the text begins, and its first two bytes, of which the end token has one and a space."""
    data = np.frombuffer(b"".join([b"   " + b" ".join(words) + b" " for words in texts]), np.uint8)
    at = np.flatnonzero((data[1:] != 32) & (data[:-1] == 32)) + 1
    near = data.astype(np.uint64)
    return near[at - 3] << np.uint64(24) | near[at - 2] << np.uint64(16) | near[at] << np.uint64(8) | near[at + 1]


def _named(starts: np.ndarray) -> np.ndarray:
    """Starts as in the vocabulary, five bytes each."""
    return np.concatenate([np.full((len(starts), 1), 32, np.uint8), starts.astype(">u4").view(np.uint8).reshape(-1, 4)], axis=1)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key."""
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([n for _, n in parts]), len(keys))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(kind, word, a, b, h): how often each token, and each start of a token, occurs in documents of a kind, in the counting fold, the
    mixing fold and held-out documents."""
    names = ["kind", "word", "a", "b", "h"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[Counter() for _ in range(3)] for _ in range(bm.KINDS)]
        begun: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            for kind, own in enumerate(counts):
                words = list({**own[0], **own[1], **own[2]})
                for at in range(0, len(words), 100_000):
                    part = words[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(part), pa.int32()), pa.array(part, pa.binary()),
                         *[pa.array([c[w] for w in part], pa.int64()) for c in own]], names=names)
                for c in own:
                    c.clear()

        def flush_starts():
            keys, n = _merge(begun)
            begun.clear()
            for at in range(0, len(keys), 100_000):
                key, times = keys[at:at + 100_000], n[at:at + 100_000].astype(np.int64)
                kind, fold = np.divmod((key >> np.uint64(32)).astype(np.int64), 3)
                words = pa.FixedSizeBinaryArray.from_buffers(pa.binary(5), len(key), [None, pa.py_buffer(_named(key & np.uint64(0xFFFFFFFF)).tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), words.cast(pa.binary()), *[pa.array(times * (fold == f)) for f in range(3)]], names=names)

        for folds, texts in columns_of(pieces_of(batches), ("fold", "text")):
            tokens, groups = [], []
            for fold, text in zip(folds, texts, strict=True):
                data = lowered(text)
                kind, part = bm.kind_of(data), 2 if fold == HELD else 1 if fold == MIXING_FOLD else 0
                tokens.append([*data.split(), END])
                groups.append(kind * 3 + part)
                counts[kind][part].update(tokens[-1])
                if sum(len(c) for own in counts for c in own) > 200_000:
                    yield from flush()
            group = np.repeat(np.array(groups, np.uint64) << np.uint64(32), [len(t) for t in tokens])
            begun.append(np.unique(group | starts_of(tokens), return_counts=True))
            if sum(len(k) for k, _ in begun) > 1_000_000:
                begun[:] = [_merge(begun)]
                if len(begun[0][0]) > 700_000:
                    yield from flush_starts()
        yield from flush()
        if begun:
            yield from flush_starts()

    parts = docs.select(crc_mod(F.col("doc_id"), FOLDS).alias("fold"), "text").mapInArrow(
        run, "kind int, word binary, a long, b long, h long")
    return parts.groupBy("kind", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("h").alias("h"))


def start_weights(starts: DataFrame, columns: str) -> np.ndarray:
    """By ``columns``, how often words of a kind begin with two bytes (kinds x 256 x 256)."""
    out = np.zeros((bm.KINDS, 256, 256))
    rows = starts.groupBy("kind", F.expr("substring(word, 4, 2)").alias("two")).agg(F.sum(F.expr(" + ".join(columns))).alias("n"))
    for r in rows.collect():
        out[r["kind"], r["two"][0], r["two"][1]] = r["n"]
    return out


def frequent_from(vocab: DataFrame, most: int) -> int:
    """The least count from which on there are at most ``most`` words."""
    n = F.col("a") + F.col("b") + F.col("h")
    step = F.when(n < 64, n).otherwise(F.floor(F.log2(n.cast("double")) * 32) - 6 * 32 + 64).cast("int")
    rows = vocab.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min(n).alias("least")).collect()
    least, words = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["step"]):
        words += r["words"]
        if words > most:
            break
        least = r["least"]
    return least


def low_bits_of(slices: DataFrame) -> int:
    """Size of the shared table, by the number of contexts in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches):
            for at, coded, _ in s.blocks():
                found = bm.sampled_contexts(coded, s.kinds[at], *s.nodes(at, coded))
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], names=["context"])
    return bm.low_bits_for(slices.mapInArrow(run, "context long").distinct().count() * bm.SAMPLED)


def low_tables(slices: DataFrame, columns: str, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The shared table, counted over the whole vocabulary, by ``columns``. A large one is counted a range of slots after the other."""
    part_bits = min(low_bits, 24)

    def ranged(place: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            zeros, ones = np.zeros(1 << part_bits), np.zeros(1 << part_bits)
            for s in _slices(batches):
                weight = _weight(s, columns)
                for at, coded, _ in s.blocks(only=weight > 0):
                    nodes, bits = s.bits(at, coded, low_bits)
                    bm.count_low(bits, nodes.sums(weight[at]), zeros, ones, place)
            from pyspark import TaskContext
            lane = TaskContext.get().partitionId()
            chunks = zip(zeros.reshape(-1, 1 << CHUNK), ones.reshape(-1, 1 << CHUNK), strict=True)
            rows = ((k, np.flatnonzero((z > 0) | (o > 0)), z, o) for k, (z, o) in enumerate(chunks, place << part_bits - CHUNK))
            for some in batched((r for r in rows if len(r[1])), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, *_ in some], pa.int32()), pa.array([lane] * len(some), pa.int32()),
                     pa.array([s.astype(np.uint16).tobytes() for _, s, *_ in some], pa.binary()),
                     pa.array([z[s].astype(np.float32).tobytes() for _, s, z, _ in some], pa.binary()),
                     pa.array([o[s].astype(np.float32).tobytes() for _, s, _, o in some], pa.binary())],
                    names=["chunk", "lane", "at", "zeros", "ones"])
        return run

    def add(table: pa.Table) -> pa.Table:
        zeros, ones = np.zeros(1 << CHUNK), np.zeros(1 << CHUNK)
        for at, z, o in zip(*[table.column(c).to_pylist() for c in ("at", "zeros", "ones")], strict=True):
            where = np.frombuffer(at, np.uint16)
            zeros[where] += np.frombuffer(z, np.float32)
            ones[where] += np.frombuffer(o, np.float32)
        used = np.flatnonzero((zeros > 0) | (ones > 0))
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()], pa.int32()),
                         "lane": pa.array([0], pa.int32()),
                         "at": pa.array([used.astype(np.uint16).tobytes()], pa.binary()),
                         "zeros": pa.array([zeros[used].astype(np.float32).tobytes()], pa.binary()),
                         "ones": pa.array([ones[used].astype(np.float32).tobytes()], pa.binary())})

    schema = "chunk int, lane int, at binary, zeros binary, ones binary"
    parts = reduce(DataFrame.union, [slices.mapInArrow(ranged(k), schema) for k in range(1 << low_bits - part_bits)])
    lanes = max(1, math.isqrt(slices.rdd.getNumPartitions()))      # a group holds a few dozen rows at most
    summed = (parts.withColumn("lane", F.pmod("lane", F.lit(lanes))).groupBy("chunk", "lane").applyInArrow(add, schema)
              .groupBy("chunk").applyInArrow(add, schema))
    zeros, ones = np.zeros(1 << low_bits, np.uint8), np.zeros(1 << low_bits, np.uint8)
    for r in summed.toLocalIterator():
        where = np.frombuffer(r["at"], np.uint16).astype(np.int64) + (r["chunk"] << CHUNK)
        zeros[where] = bm.squeeze(np.frombuffer(r["zeros"], np.float32))
        ones[where] = bm.squeeze(np.frombuffer(r["ones"], np.float32))
    return zeros, ones


#: Bytes of the words from which the weights are learned in one step, and of those whose bits a worker holds at once.
LEARNED, HELD_AT_ONCE = 200_000, 40_000


def _mixing_blocks(slices: Iterator[Slice], shared):
    """Bits of the mixing fold's words, their inputs by their prefix counts over the counting folds, their gates and weight, after
    the step they are learned in; a step is several blocks."""
    tables, beyond, low_bits = shared.value
    for s in slices:
        b = s.counts["b"]
        if b.any():
            counted = s.counted("a", beyond)
            step = np.cumsum([len(w) if n else 0 for w, n in zip(s.coded, b, strict=True)]) // LEARNED
            for at, coded, _ in s.blocks(None, b > 0, HELD_AT_ONCE):
                nodes, bits = s.bits(at, coded, low_bits)
                yield (s.id, step[at[0]]), bits, *bm.inputs_of(bits, tables, counted(at, nodes)), nodes.sums(b[at])[bits.word]


def _summed(slices: DataFrame, shared, mixer: bm.Mixer, task) -> np.ndarray:
    """Adds up what ``task`` makes of the mixing fold in each partition: (index, value, weight) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, value, weight in task(_mixing_blocks(_slices(batches), shared), mixer):
            yield pa.RecordBatch.from_arrays([pa.array(index, pa.int32()), pa.array(value, pa.float64()), pa.array(weight, pa.float64())],
                                             names=["i", "v", "w"])
    rows = slices.mapInArrow(run, "i int, v double, w double")
    out = np.zeros((bm.GATES * bm.STEPS, 2))
    for r in rows.groupBy("i").agg(F.sum("v").alias("v"), F.sum("w").alias("w")).collect():
        out[r["i"]] = r["v"], r["w"]
    return out


def _train(blocks, mixer: bm.Mixer):
    mixer = bm.Mixer(mixer.weights.copy(), mixer.refine)
    total = np.zeros(bm.GATES)
    for seen, (_, step) in enumerate(groupby(blocks, key=lambda block: block[0]), 1):
        total += bm.learn(((x, gate, bits.bit, weight) for _, bits, x, gate, weight in step), mixer, 0.8 / math.sqrt(seen))
    mass = np.repeat(total, bm.INPUTS)
    yield np.arange(bm.GATES * bm.INPUTS), mixer.weights.ravel() * mass, mass


def _refine(blocks, mixer: bm.Mixer):
    ones, all_ = np.zeros(bm.GATES * bm.STEPS), np.zeros(bm.GATES * bm.STEPS)
    for _, bits, x, gate, weight in blocks:
        low, part = bm.steps_of(bm.mixed(x, gate, mixer.weights))
        for at, share in ((low, 1 - part), (low + 1, part)):
            i = gate * bm.STEPS + at
            ones += np.bincount(i, weight * share * bits.bit, len(ones))
            all_ += np.bincount(i, weight * share, len(ones))
    yield np.arange(len(ones)), ones, all_


def word_costs(vocab: DataFrame, slices: DataFrame, shared, mixer: bm.Mixer, columns: str) -> DataFrame:
    """(kind, word, c, n, cost): the word's training count in all kinds, null for a start, its count in this kind, held-out included,
    and the log10 probability, by what is counted in ``columns``, of the start or of the word without its start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, beyond, low_bits = shared.value
        for s in _slices(batches):
            n = sum(s.counts[c] for c in "abh")
            counted = s.counted(columns, beyond)
            for at, coded, _ in s.blocks():
                nodes, bits = s.bits(at, coded, low_bits)
                cost = nodes.totals(bm.log2_cost(bits, tables, mixer, len(nodes.first), counted(at, nodes))) * -math.log10(2)
                if s.before is None:
                    words = [w if w == END else w[:-1] for w in coded]
                else:
                    words = [(b" " + bytes(two) + w).ljust(5) for two, w in zip(s.before[at].tolist(), coded, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(s.kinds[at], pa.int32()), pa.array(words, pa.binary()), pa.array(n[at]), pa.array(cost)],
                                                 names=["kind", "word", "n", "cost"])
    counted = vocab.groupBy("word").agg(F.sum(F.expr("a + b")).alias("c"))
    coded = slices.mapInArrow(run, "kind int, word binary, n long, cost double")
    return coded.join(counted, "word", "left").select("kind", "word", "c", "n", "cost")


def lm_scores(docs: DataFrame, frequent: int = 1 << 17) -> DataFrame:
    """Per row: held_out, token counts, the add-one unigram score, the model's log10 probability, bits per byte.

    A null or empty text is the end token alone. A null id counts as training. Repeated rows are counted
    and scored each. Without any training document every word costs what untrained predictors say.
    ``frequent`` bounds the list of words kept by every worker. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    every = materialise(vocabulary(docs), "vocabulary")
    vocab, starts = every.where(f"NOT {IS_START}"), every.where(IS_START)
    sums = vocab.groupBy("word").agg(F.sum(F.expr("a + b")).alias("c")).agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_train, floor = sums["n"] or 0, (sums["n"] or 0) + (sums["v"] or 0) + 1
    least, least_start = frequent_from(vocab, frequent), frequent_from(starts, 4 * frequent)
    ends = {r["kind"]: r["n"] for r in vocab.where(F.col("word") == F.lit(END)).select("kind", F.expr("a + b AS n")).collect()}
    prior = np.log10([(ends.get(k, 0) + 1) / (sum(ends.values()) + bm.KINDS) for k in range(bm.KINDS)])
    slices = materialise(sliced(vocab).withColumn(STARTS, F.lit(False)).union(sliced(starts).withColumn(STARTS, F.lit(True))), "slices")
    of_words = slices.where(~F.col(STARTS))
    low_bits, ends_ = low_bits_of(slices), slice_ends(of_words)

    def counted(columns: str):
        beyond = beyond_slices(of_words, ends_, columns) | {STARTS: start_weights(starts, columns)}
        return spark.sparkContext.broadcast((bm.Tables(low_tables(slices, columns, low_bits)), beyond, low_bits))

    shared = counted("a")
    mixer = bm.Mixer.fresh()
    got = _summed(slices, shared, mixer, _train)[:bm.GATES * bm.INPUTS]
    learned = np.where(got[:, 1] > 0, got[:, 0] / np.maximum(got[:, 1], 1e-9), mixer.weights.ravel())
    mixer.weights = learned.reshape(bm.GATES, bm.INPUTS)
    got = _summed(slices, shared, mixer, _refine)
    mixer.refine = ((got[:, 0] + 20 * mixer.refine.ravel()) / (got[:, 1] + 20)).reshape(bm.GATES, bm.STEPS)
    shared.unpersist()
    costs = materialise(word_costs(vocab, slices, counted("ab"), mixer, "ab"), "word-costs")

    listed_start = F.col("c").isNull() & (F.col("n") >= least_start)
    begun = costs.where(listed_start).select("kind", "word", "cost").toArrow()
    begun_key = np.array([k << 32 | int.from_bytes(w[1:], "big") for k, w in zip(begun["kind"].to_pylist(), begun["word"].to_pylist(), strict=True)], np.uint64)
    order = np.argsort(begun_key)
    known = costs.where(F.col("c").isNotNull() & (F.col("n") >= least)).collect()
    lists = [{} for _ in range(bm.KINDS)]
    for i, r in enumerate(known):
        lists[r["kind"]][bytes(r["word"])] = i
    listed = spark.sparkContext.broadcast((
        lists, np.array([r["c"] for r in known] + [0], float), np.array([r["cost"] for r in known] + [0.0]),
        np.append(begun_key[order], np.uint64(1 << 63)), np.append(begun["cost"].to_numpy()[order], 0.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, count, cost, start_keys, start_cost = listed.value
        base = np.log10((count + 1) / floor)
        base[-1] = 0.0
        for ids, texts in columns_of(pieces_of(batches), ("doc_id", "text")):
            texts = [lowered(text) for text in texts]
            tokens, kind_of = [[*data.split(), END] for data in texts], [bm.kind_of(data) for data in texts]
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
            starts = np.array(kind_of, np.uint64)[owner] << np.uint64(32) | starts_of(tokens)
            at = np.searchsorted(start_keys, starts)
            met = start_keys[at] == starts
            begun = np.bincount(owner, start_cost[at] * met, len(texts)).tolist()
            left = [[] for _ in texts]
            for i, name in zip(owner[~met].tolist(), _named(starts[~met] & np.uint64(0xFFFFFFFF)), strict=True):
                left[i].append(name.tobytes())
            rows = []
            for data, words, kind, first, few in zip(texts, tokens, kind_of, begun, left, strict=True):
                own = place[kind]
                at = np.fromiter(map(own.get, words, repeat(-1)), np.int64, len(words))
                rare = Counter(compress(words, (at < 0).tolist()))
                rare.update(few)
                rows.append((len(words), int((count[at] > 0).sum()), float(base[at].sum()),
                             float(cost[at].sum()) + first + float(prior[kind]), max(1, len(data)), kind, list(rare), list(rare.values())))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]],
                names=["doc_id", "n_tokens", "known", "base", "cost", "bytes", "kind", "rare", "times"])

    rows = materialise(docs.mapInArrow(run, "doc_id long, n_tokens long, known long, base double, cost double, bytes long, kind int, "
                                            "rare array<binary>, times array<long>")
                       .withColumn("rid", F.monotonically_increasing_id()), "scored")
    rest = (rows.select("rid", "kind", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("rid", "kind", F.col("r.rare").alias("word"), "r.times")
            .join(costs.where(F.col("n") < F.when(F.col("c").isNull(), F.lit(least_start)).otherwise(F.lit(least))).select("kind", "word", "c", F.col("cost").alias("each")), ["word", "kind"])
            .groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(F.lit(0))).alias("known_"),
                                F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(floor)))).alias("base_"),
                                F.sum(F.col("times") * F.col("each")).alias("cost_")))
    score = F.col("cost") + F.coalesce("cost_", F.lit(0.0))
    return rows.select("rid", "doc_id", "n_tokens", "known", "base", "cost", "bytes").join(rest, "rid", "left").select(
        "doc_id", (crc_mod(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("known_", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_", F.lit(0.0))).alias("base_score"), score.alias("score"),
        (-score / F.lit(math.log10(2)) / F.col("bytes")).alias("bits_per_byte"))
