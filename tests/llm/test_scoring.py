import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from conftest import MEDIUM, SMALL
from helpers import awkward, clashing, docs_of, empty, sentence

from herdcast.llm import bit_model, importance, language_id, lm_scoring


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check_base(df, **options):
    rows = [(r.doc_id, re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()) + [b"end\n"]) for r in df.select("doc_id", df["text"]).collect()]
    train = Counter(w for i, ws in rows if not held(i) for w in ws)
    n, v = sum(train.values()), len(train)
    want = sorted(((i, held(i), len(ws), sum(train[w] > 0 for w in ws), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws), 5))
                   for i, ws in rows), key=str)
    out = lm_scoring.lm_scores(df, **options).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out), key=str) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    return out


def test_lm_base_and_model(spark):
    df = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = check_base(df)
    few = {r.doc_id: r for r in lm_scoring.lm_scores(df, frequent=500).collect()}      # most words take the joined way
    assert {i: r.n_known for i, r in few.items()} == {r.doc_id: r.n_known for r in out}
    assert all(abs(few[r.doc_id].base_score - r.base_score) < 1e-6 for r in out)
    tokens = sum(r.n_tokens for r in out if r.held_out)
    assert sum(r.score for r in out if r.held_out) / tokens > sum(r.base_score for r in out if r.held_out) / tokens - 0.15


def test_lm_awkward_rows(spark):
    check_base(awkward(spark))
    assert lm_scoring.lm_scores(empty(spark)).count() == 0
    assert lm_scoring.lm_scores(clashing(awkward(spark))).count() == 15
    one = [i for i in range(99) if held(i)][:1]
    assert lm_scoring.lm_scores(docs_of(spark, [(one[0], "a b", "en", "a")])).first().n_known == 0


def test_word_codes_are_a_distribution():
    """Over all words of one byte and what may follow, the coded probabilities add up to one at most."""
    words, kinds = [b"ab", b"ba", b"aab"], np.zeros(3, int)
    zeros, ones = np.zeros(1 << bit_model.LOW_BITS), np.zeros(1 << bit_model.LOW_BITS)
    bit_model.count_low(bit_model.bits_of(words, kinds, b"\n"), np.array([5.0, 2.0, 1.0]), zeros, ones)
    tables = bit_model.Tables((bit_model.squeeze(zeros), bit_model.squeeze(ones)), bit_model.prefix_table(words, kinds, np.array([5.0, 2.0, 1.0]), b"\n"))
    every = [bytes([c]) for c in range(256) if c not in (9, 10, 11, 12, 13, 32)]
    cost = bit_model.log2_cost(bit_model.bits_of(every, np.zeros(len(every), int), b"\n"), tables, bit_model.Mixer.fresh(), len(every))
    assert 0 < (2.0 ** -cost).sum() <= 1 + 1e-9


def test_importance(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    out = importance.classify(docs, labels)
    assert out.count() == docs.count()
    judged = out.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in judged}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.6
    sampler = importance.fit(docs, labels)
    assert importance.resample(clashing(docs), sampler).count() == out.where("kept").count()


def test_importance_model_is_the_counted_ratio(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng, 20), "en", "a") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 10), 0) for i in range(20)], "doc_id long, quality int, toxic int")
    sampler = importance.fit(docs_of(spark, rows), labels, buckets=64)
    from herdcast.llm.common import WordHash
    raw, good = np.zeros(64), np.zeros(64)
    for i, text, *_ in rows:
        c = np.bincount(importance.ngrams(text, 64, WordHash()), minlength=64)
        raw += c
        good += c * (i < 10)
    want = np.log((good + 1) / (good.sum() + 64)) - np.log((raw + 1) / (raw.sum() + 64))
    assert np.allclose(sampler.log_ratio, want)
    keys = sorted((r.key for r in importance.score(docs_of(spark, rows), sampler).collect()), reverse=True)
    assert sampler.least == keys[math.ceil(40 * 0.52) - 1]


def test_kth_largest_with_ties(spark):
    rng = random.Random(2)
    values = [rng.choice([-1e300, -3.5, 0.0, 1.0, 1.0 + 2 ** -50, 7.25, rng.gauss(0, 1)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 2, 77, 250, 499, 500):
        assert importance.kth_largest(df, "key", k, parts=7) == sorted(values, reverse=True)[k - 1]


def test_importance_awkward_rows(spark):
    labels = spark.createDataFrame([(5, 1, 0), (7, 1, None), (8, 0, 0), (None, 1, 0), (99, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    out = importance.classify(clashing(awkward(spark)), labels)
    assert out.count() == 15 and out.where("n_ngrams = 0").select("log_weight").distinct().count() == 1
    assert importance.classify(empty(spark), labels).count() == 0
    assert importance.classify(awkward(spark), labels.where("false")).where("kept").count() == 15


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    out = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    aside = [r for r in out if r.held_out]
    assert sum(r.lang_pred == r.lang for r in aside) / len(aside) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 for r in out)
    assert sum(r.rejected for r in out) / len(out) < 0.02


def test_language_learns_only_from_its_folds(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, 15), "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "seen", "a") for i in range(60)]
    assert language_id.fit(docs_of(spark, rows)).languages == ["seen"]


def test_language_awkward_rows(spark):
    df = awkward(spark)
    model = language_id.fit(df)
    out = language_id.identify(clashing(df), model).collect()
    und = sorted((r.doc_id for r in out if r.lang_pred == "und"), key=str)
    assert und == sorted([1, 2, 3, 11, None], key=str) and all(r.rejected for r in out if r.lang_pred == "und")
    assert language_id.identify(empty(spark), model).count() == 0
    assert {r.lang_pred for r in language_id.identify(df, language_id.fit(empty(spark))).collect()} == {"und"}
    assert language_id.accepted(df, model).columns == df.columns


def test_calibration():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 4000)
    logits = 3 * np.eye(3)[truth] * (rng.random(4000) < 0.85)[:, None] + rng.normal(0, 1, (4000, 3))
    t, least = language_id.calibrate(5 * logits, truth, 0.97)
    p = language_id.softmax(5 * logits / t)
    ok = p.max(axis=1) >= least
    assert t > 1 and 0 < ok.mean() < 1 and (p.argmax(axis=1) == truth)[ok].mean() >= 0.97


def test_lm_every_word_has_its_own_counts(spark):
    """Prefixes are counted over all words, so the list kept by the workers changes no score."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    few, all_ = ({r.doc_id: r.score for r in lm_scoring.lm_scores(df, **o).collect()} for o in ({"frequent": 50}, {}))
    assert all(abs(few[i] - all_[i]) < 1e-6 * abs(all_[i]) for i in all_)


def test_prefix_counts_across_slices(spark):
    rng = random.Random(5)
    words = {(rng.randrange(2), bytes(rng.choice(b"ab\x01\xc3") for _ in range(rng.randint(1, 6)))) for _ in range(150)}
    words |= {(0, b"\n"), (1, b"\n"), (1, b"x" * 90 + b"a"), (1, b"x" * 90 + b"b")}
    rows = [(k, bytearray(w), rng.randint(0, 5), rng.randint(0, 5), 1) for k, w in words]
    vocab = spark.createDataFrame(rows, "kind int, word binary, a long, b long, h long")
    slices = lm_scoring.materialise(lm_scoring.sliced(vocab, words=7), "test-slices")
    ends = lm_scoring.slice_ends(slices)
    beyond = lm_scoring.beyond_slices(slices, ends, "ab")
    want = Counter()
    path = lambda w: "".join(f"{c:08b}" for c in (w if w == b"\n" else w + b" "))
    for k, w, a, b, _ in rows:
        bits = path(bytes(w))
        for t in range(len(bits)):
            want[k, bits[:t + 1]] += a + b
    seen = 0
    for s in lm_scoring._slices(slices.toArrow().to_batches()):
        got = bit_model.prefix_counts(s.coded, s.kinds, (s.counts["a"] + s.counts["b"]).astype(float), beyond[s.id])
        at = 0
        for k, w in zip(s.kinds, s.coded, strict=True):
            bits = "".join(f"{c:08b}" for c in w)
            for t in range(len(bits)):
                assert got[:, at].tolist() == [want[k, bits[:t] + "0"], want[k, bits[:t] + "1"]]
                at += 1
            seen += 1
    assert seen == len(words) and len(ends) > 15


def test_low_table_grows_with_the_contexts():
    assert bit_model.low_bits_for(0) == bit_model.low_bits_for(1 << 20) == bit_model.LOW_BITS
    assert bit_model.low_bits_for(10_000_000) == 25


def test_lm_scores_know_the_mixing_fold(spark):
    """Each of two words gains where it is the one planted in the mixing fold."""
    fold = {k: [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == k] for k in range(7)}

    def lead(planted):
        rng = random.Random(8)
        rows = [(i, sentence(rng, 40), "en", "a") for k in (0, 1, 3) for i in fold[k][:30]]
        rows += [(i, sentence(rng, 40) + f" {planted}" * 5 * (i % 2), "en", "a") for i in fold[6][:30]]
        rows += [(fold[2][0], "qjvkzxw", "en", "a"), (fold[2][1], "wxzkvjq", "en", "a")]
        got = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs_of(spark, rows)).where("held_out").collect()}
        return got[fold[2][0]] - got[fold[2][1]]
    assert lead("qjvkzxw") > lead("wxzkvjq") + 4


def test_lm_workers_hold_little_at_once(spark):
    """Coding a slice of the vocabulary, but for what is learned in one step, holds the bits of few words."""
    words = [b"w%06d " % i for i in range(30_000)]
    n = np.ones(len(words), np.int64)
    s = lm_scoring.Slice(0, words, np.zeros(len(words), np.int64), {"a": n, "b": n, "h": n})
    prefix = bit_model.prefix_counts(words, s.kinds, n.astype(float))
    tables = bit_model.Tables((np.zeros(1 << bit_model.LOW_BITS, np.uint8),) * 2)
    import tracemalloc
    tracemalloc.start()
    cost = [bit_model.log2_cost(bit_model.bits_of_coded(coded, s.kinds[at], hashed=False), tables, bit_model.Mixer.fresh(), len(coded), own)
            for at, coded, own in s.blocks(prefix)]
    assert len(np.concatenate(cost)) == len(words) and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_lm_counting_and_learning_hold_little_at_once():
    """Neither makes an array of the whole table or of the bits of a whole step; in parts a step learns the same."""
    import tracemalloc
    rng = np.random.default_rng(4)
    words = sorted({b"%x " % v for v in rng.integers(0, 1 << 28, 30_000)})
    s = lm_scoring.Slice(0, words, np.zeros(len(words), np.int64), {c: rng.integers(0, 9, len(words)) for c in "abh"})
    zeros, ones = np.zeros(1 << 24), np.zeros(1 << 24)
    tracemalloc.start()
    for at, coded, _ in s.blocks():
        bit_model.count_low(bit_model.bits_of_coded(coded, s.kinds[at], 24, hashed=False), s.counts["a"][at].astype(float), zeros, ones)
    counting = tracemalloc.get_traced_memory()[1]

    class Shared:
        value = bit_model.Tables((bit_model.squeeze(zeros), bit_model.squeeze(ones))), {0: bit_model.NOTHING}, 24
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    got = next(lm_scoring._train(lm_scoring._mixing_blocks(iter([s]), Shared), bit_model.Mixer.fresh()))
    learning = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert counting < 100 << 20 and learning < 150 << 20
    assert [k for k, *_ in lm_scoring._mixing_blocks(iter([s]), Shared)] == [(0, 0)] * 5 + [(0, 1)]
    once, parted = bit_model.Mixer.fresh(), bit_model.Mixer.fresh()
    blocks = [tuple(b) for _, *b in lm_scoring._mixing_blocks(iter([s]), Shared)]
    parts = [(x, gate, bits.bit, weight) for bits, x, gate, weight in blocks]
    mass = bit_model.learn(parts, parted, 0.8)
    bit_model.learn([tuple(np.concatenate(c, axis=-1) for c in zip(*parts, strict=True))], once, 0.8)
    assert np.allclose(once.weights, parted.weights, rtol=1e-9) and got[2].sum() == mass.sum() * bit_model.INPUTS


def test_lm_words_that_begin_alike_are_worked_on_once():
    """Nodes give every word's counts, sums and cost, and are about as many as the bytes in which sorted words differ."""
    rng = np.random.default_rng(8)
    pairs = sorted({(int(k), b"%d " % v) for k, v in zip(rng.integers(0, 3, 4_000), rng.integers(0, 6_000, 4_000), strict=True)})
    pairs += [(3, b"q" * 400 + b"a "), (3, b"q" * 400 + b"b "), (3, b"\xc3\xa4 "), (4, b"\xc3\xa4 ")]
    kinds, coded = np.array([k for k, _ in pairs]), [w for _, w in pairs]
    weight = rng.integers(0, 5, len(coded)).astype(float)
    nodes = bit_model.Nodes.of(coded, kinds)
    assert len(nodes.first) < 0.5 * len(nodes.data) and [k for k, w in enumerate(coded) if len(w) > 400] == [len(coded) - 4, len(coded) - 3]

    through = {}                                     # brute force: weight by what is known before a bit, and the bit
    for k, w, n in zip(kinds, coded, weight, strict=True):
        bits = np.unpackbits(np.frombuffer(w, np.uint8)).tobytes()
        for t in range(len(bits)):
            through.setdefault((k, bits[:t]), [0.0, 0.0])[bits[t]] += n
    every = [through[k, bits[:t]] for k, w in pairs for bits in [np.unpackbits(np.frombuffer(w, np.uint8)).tobytes()] for t in range(len(bits))]
    assert np.array_equal(bit_model.node_counts(nodes, weight)[:, nodes.node].reshape(2, -1).T, every)
    prefix = bit_model.prefix_counts(coded, kinds, weight)
    first, last = bit_model.end_paths(coded, kinds, weight, 7, 9)
    assert np.array_equal(first, prefix[:, :8]) and np.array_equal(last, prefix[:, -8 * len(coded[-1]):][:, :10])
    assert np.array_equal(bit_model.end_paths([b"a "], np.zeros(1, int), np.ones(1), 3, -1)[0], [[1, 0, 0, 1], [0, 1, 1, 0]])

    tables = []
    for whole in (None, nodes):
        counts = np.zeros(1 << bit_model.LOW_BITS), np.zeros(1 << bit_model.LOW_BITS)
        bit_model.count_low(bit_model.bits_of_coded(coded, kinds, hashed=False, nodes=whole), weight if whole is None else whole.sums(weight), *counts)
        tables.append(counts)
    assert all(np.array_equal(x, y) for x, y in zip(*tables, strict=True))
    tables = bit_model.Tables(tuple(bit_model.squeeze(c) for c in tables[0]))
    mixer = bit_model.Mixer.fresh()
    own = bit_model.bits_of_coded(coded, kinds, hashed=False, nodes=nodes)
    each = bit_model.log2_cost(own, tables, mixer, len(nodes.first), bit_model.node_counts(nodes, weight).reshape(2, -1))
    cost = bit_model.log2_cost(bit_model.bits_of_coded(coded, kinds, hashed=False), tables, mixer, len(coded), prefix)
    assert np.allclose(np.bincount(nodes.word, each[nodes.node]), cost, rtol=1e-12)


def test_lm_contexts_reach_over_words(spark):
    """A word's first bytes are coded after the last ones of the word before, so the order of words counts."""
    rng = random.Random(12)
    fold = {k: [i for i in range(900) if zlib.crc32(str(i).encode()) % 7 == k] for k in range(7)}
    pair = lambda: [f"x{rng.choice('abcd')}q", f"v{rng.choice('abcd')}z"]
    rows = [(i, " ".join(w for _ in range(30) for w in pair()), "en", "a") for k in (0, 1, 3, 6) for i in fold[k][:40]]
    held_out = [w for _ in range(30) for w in pair()]
    rows += [(fold[2][0], " ".join(held_out), "en", "a"), (fold[2][1], " ".join(sorted(held_out)), "en", "a")]
    for options in ({}, {"frequent": 2}):
        got = {r.doc_id: r for r in lm_scoring.lm_scores(docs_of(spark, rows), **options).where("held_out").collect()}
        assert abs(got[fold[2][0]].base_score - got[fold[2][1]].base_score) < 1e-9
        assert got[fold[2][0]].score > got[fold[2][1]].score + 20


def test_lm_starts_and_rests_add_up_to_the_text(spark):
    """Starts and words are counted as they stand in the texts, and cost as much as all bits of a text, coded one word after the other."""
    rng = random.Random(13)
    words = ["a", "b", "ab", "abc", "abcd", "b\u00e4", "\u00e4", "xyzzy" * 9]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(60)] + [None, " \n"]
    fold = [zlib.crc32(str(i).encode()) % 7 for i in range(len(texts))]
    want, streams = Counter(), []
    for text, f in zip(texts, fold, strict=True):
        data = (text or "").encode().lower()
        kind, coded, stream = bit_model.kind_of(data), [w + b" " for w in data.split()] + [b"\n"], b"   "
        streams.append((kind, coded, []))
        for w in coded:
            two = (w + b" ")[:2]
            want[kind, w if w == b"\n" else w[:-1], "h" if f == 2 else "b" if f == 6 else "a"] += 1
            want[kind, b" " + stream[-3:-1] + two, "h" if f == 2 else "b" if f == 6 else "a"] += 1
            streams[-1][2].append(list(stream[-3:-1]))
            stream += w
    vocab = lm_scoring.vocabulary(docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    assert {(r.kind, bytes(r.word), c): r[c] for r in vocab for c in "abh" if r[c]} == dict(want)

    every = spark.createDataFrame(vocab)
    starts = every.where(lm_scoring.IS_START)
    slices = lm_scoring.sliced(every.where(f"NOT {lm_scoring.IS_START}")).withColumn("starts", lm_scoring.F.lit(False)).union(
        lm_scoring.sliced(starts).withColumn("starts", lm_scoring.F.lit(True)))
    of_words = slices.where("NOT starts")
    beyond = lm_scoring.beyond_slices(of_words, lm_scoring.slice_ends(of_words), "ab") | {"starts": lm_scoring.start_weights(starts, "ab")}
    tables = bit_model.Tables(lm_scoring.low_tables(slices, "ab", bit_model.LOW_BITS))
    shared = spark.sparkContext.broadcast((tables, beyond, bit_model.LOW_BITS))
    mixer = bit_model.Mixer.fresh()
    cost = {(r.kind, bytes(r.word)): r.cost for r in lm_scoring.word_costs(every.where(f"NOT {lm_scoring.IS_START}"), slices, shared, mixer, "ab").collect()}

    through, low = Counter(), (np.zeros(1 << bit_model.LOW_BITS), np.zeros(1 << bit_model.LOW_BITS))
    bits_of = lambda w: np.unpackbits(np.frombuffer(w, np.uint8)).tobytes()
    for (kind, coded, before), f in zip(streams, fold, strict=True):
        if f != 2:
            bits = bit_model.bits_of_coded(coded, np.full(len(coded), kind), hashed=False, before=np.array(before))
            bit_model.count_low(bits, np.ones(len(coded)), *low)
            through.update((kind, bits_of(w)[:t + 1]) for w in coded for t in range(8 * len(w)))
    plain = bit_model.Tables(tuple(bit_model.squeeze(c) for c in low))
    assert all(np.array_equal(x, y) for x, y in zip(plain.low, tables.low, strict=True))
    for kind, coded, before in streams:
        bits = bit_model.bits_of_coded(coded, np.full(len(coded), kind), hashed=False, before=np.array(before))
        prefix = np.array([[through[kind, bits_of(w)[:t] + bytes([side])] for w in coded for t in range(8 * len(w))] for side in (0, 1)], float)
        whole = bit_model.log2_cost(bits, plain, mixer, len(coded), prefix).sum() * -math.log10(2)
        own = sum(cost[kind, w if w == b"\n" else w[:-1]] + cost[kind, b" " + bytes(two) + (w + b" ")[:2]] for w, two in zip(coded, before, strict=True))
        assert abs(whole - own) < 1e-9 * abs(whole)
