import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference
from conftest import SMALL
from helpers import awkward, clashing, docs_of, empty, sentence

from herdcast.llm import alignment, byte_bpe, prefix_trie, queries, sql, tiered_packing

BYTE, PIECE = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def byte_encoder(special):
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(BYTE)
    encoder.encode_special_tokens = not special
    return encoder


# ------------------------------------------------------------------ encoders


def test_both_encoders_agree():
    with open(BYTE, encoding="utf-8") as f:
        rules = f.read()
    one = byte_bpe.ByteBpe(rules, special=True)
    plain = byte_bpe.ByteBpe(rules, special=False)
    assert one.fast is not None
    slow, slow_plain = byte_encoder(True), byte_encoder(False)
    rng = random.Random(5)
    chars = [chr(c) for c in [*range(0, 0x600), 0x2028, 0x3000, 0x4E2D, 0xAC00, 0x1F600, 0xE000, 0x10FFFF]] + ["'s", "'ll", "  ", "\n\n", "<|endoftext|>"]
    for _ in range(300):
        text = "".join(rng.choice(chars) for _ in range(rng.randrange(60)))
        assert one.ids(text) == slow.encode(text, add_special_tokens=False).ids
        assert plain.ids(text) == slow_plain.encode(text, add_special_tokens=False).ids
        assert b"".join(plain.bytes[i] for i in plain.ids(text)) == text.encode()


def test_other_vocabularies_go_through_tokenizers():
    with open(queries.vocabulary("word_bpe_49k.json"), encoding="utf-8") as f:
        rules = f.read()
    from tokenizers import Tokenizer
    alphabet = byte_bpe.byte_alphabet()
    assert len(alphabet) == 256 == len(set(alphabet.values()))
    assert not byte_bpe.ByteBpe._usual({"model": {"type": "BPE", "merges": []}, "normalizer": {}, "pre_tokenizer": {}}, {})
    assert Tokenizer.from_str(rules).encode("a b", add_special_tokens=False).ids


# ------------------------------------------------------------------ alignment


def brute_alignment(rows):
    """Contract columns by loops over single tokens, with tokenizers and sentencepiece themselves."""
    import sentencepiece
    a_of, b_of = byte_encoder(False), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    alphabet = byte_bpe.byte_alphabet()
    links, out = [], []
    for doc, text in rows:
        a = [(i, bytes(alphabet[c] for c in t)) for e in [a_of.encode(" " + text, add_special_tokens=False)] for i, t in zip(e.ids, e.tokens)] if text else []
        b = [(i, bytes([int(p[3:-1], 16)]) if b_of.is_byte(i) else p.replace("▁", " ").encode())
             for i, p in ((i, b_of.id_to_piece(i)) for i in b_of.encode(text))] if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            out.append((doc, 0, 0, 0, ""))
            links.append([])
            continue
        own, groups, i, j, at_a, at_b, ga, gb = [], [], 0, 0, len(a[0][1]), len(b[0][1]), [a[0][0]], [b[0][0]]
        while True:
            own.append((a[i][0], b[j][0]))
            if at_a == at_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                i, j, ga, gb = i + 1, j + 1, [], []
                if i == len(a):
                    break
                at_a, at_b = at_a + len(a[i][1]), at_b + len(b[j][1])
                ga.append(a[i][0])
                gb.append(b[j][0])
            elif at_a < at_b:
                i += 1
                at_a += len(a[i][1])
                ga.append(a[i][0])
            else:
                j += 1
                at_b += len(b[j][1])
                gb.append(b[j][0])
        links.append(own)
        out.append((doc, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(x for own in links for x in own)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    docs = Counter(x for own in links for x in set(own))
    return [(doc, n_a, n_b, n_g, len(own), sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), sha)
            for (doc, n_a, n_b, n_g, sha), own in zip(out, links)], counts, docs


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def test_alignment_against_loops(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, _, _ = brute_alignment([(r.doc_id, r.text) for r in docs.collect()])
    got = queries.op11_tokenizer_alignment(spark, SMALL)
    assert order(map(tuple, got.collect())) == order(want)


def test_alignment_awkward_rows(spark, monkeypatch):
    odd = [(20, "▁ literal", "en", "a"), (21, "<0x41> </s> <unk> <|endoftext|> ok", "en", "a"), (22, "  two  blanks ", "en", "a"),
           (23, "\x00 nul ​­ ﬁ ½ Å", "en", "a"), (24, " ", "en", "a"), (25, "漢字かな " * 50, "en", "a")]
    docs = awkward(spark).union(docs_of(spark, odd))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, counts, n_docs = brute_alignment(rows)
    got = alignment.align_tokenizers(clashing(docs), BYTE, PIECE)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert order(map(tuple, got.collect())) == order(want)
    # long texts in parts, and ranges closed early, change nothing
    with open(BYTE, encoding="utf-8") as f, open(PIECE, "rb") as g:
        rules, model = f.read(), g.read()
    monkeypatch.setattr(alignment, "LONG", 50)
    monkeypatch.setattr(alignment, "CHUNK", 200)
    monkeypatch.setattr(alignment, "POSTINGS", 50)
    found = alignment.index(docs.repartition(3), rules, model)
    pairs = alignment.pair_counts(found).collect()
    assert {(p.a_id, p.b_id): p.n_links for p in pairs} == dict(counts)
    assert {(p.a_id, p.b_id): p.n_docs for p in pairs} == dict(n_docs)
    assert order(map(tuple, alignment.align_tokenizers(docs.repartition(3), BYTE, PIECE).collect())) == order(want)
    assert alignment.align_tokenizers(empty(spark), BYTE, PIECE).count() == 0


def test_bitmaps_and_planes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 4000, 8192):
        slots = np.sort(rng.choice(alignment.RANGE, n, replace=False))
        assert alignment.slots_of(alignment.packed_bits(slots)).tolist() == slots.tolist()
        assert len(alignment.packed_bits(slots)) <= 1024
    own, want = alignment.Range(), Counter()
    for _ in range(4):
        slots = rng.choice(alignment.RANGE, 50, replace=False).tolist()
        pairs = [rng.integers(0, 9, rng.integers(1, 300)) for _ in slots]
        own.add(slots, pairs)
        want.update((int(p), s) for s, ps in zip(slots, pairs) for p in ps)
    got = Counter()
    for pair, plane, ones, bits in own.rows():
        assert ones == len(alignment.slots_of(bits))
        for s in alignment.slots_of(bits).tolist():
            got[pair, s] += 1 << max(0, plane - 1)
    assert got == want


# ------------------------------------------------------------------ prefix trie


CHATS = "conv_id long, turn long, role string, text string"


def brute_trie(rows, block=20):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        words = len([w for w in p[-1][1].encode().split()]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * words
    return [(min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(c for c in who if full[c] == p))).encode()).hexdigest()) for p, who in members.items()]


def test_trie_against_loops(spark):
    chats = spark.read.parquet(f"{SMALL}/conversations.parquet")
    want = brute_trie([tuple(r) for r in chats.select("conv_id", "turn", "role", "text").collect()])
    assert order(map(tuple, queries.op12_prefix_trie(spark, SMALL).collect())) == order(want)


def awkward_chats():
    rng = random.Random(8)
    rows = [(None, 0, "user", "nobody's"), (40, None, None, None), (41, None, "user", "null first"), (41, 0, "user", "b"), (41, 0, "user", "a"),
            (42, 0, "user", "same"), (42, 0, "user", "same"), (-7, 0, "user", "minus \x1c one\ttwo\x0bthree"), (-20, 3, "", ""), (-20, 4, "user", ":x"),
            (44, 0, "us", "er:x"), (45, 0, "user", "x"), (46, 0, "user", sentence(rng, 3000)), (47, -1, "user", "été 漢字")]
    rows += [(60 + c, t, "user", rng.choice("ab")) for c in range(60) for t in range(rng.randrange(1, 6))]      # many equal and nested ones
    rows += [(c, t, "user", "copy copy") for c in range(200, 260) for t in range(4)]
    rows += [(300, t, "assistant", f"turn {t}") for t in range(700)]                                                # a long one
    return rows


def test_trie_awkward_rows(spark):
    import duckdb
    rows = awkward_chats()
    chats = spark.createDataFrame(rows, CHATS)
    for name in ("key", "depth", "owner", "weight", "part", "TEXT"):
        chats = chats.select("*", __import__("pyspark").sql.functions.lit("clash").alias(name))
    got = prefix_trie.prefix_trie(chats)
    assert order(map(tuple, got.collect())) == order(brute_trie(rows))
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", [r for r in rows if r[0] != 300])
    assert difference(prefix_trie.prefix_trie(chats.where("conv_id IS NULL OR conv_id <> 300")), con, sql.PREFIX_TRIE) is None
    assert prefix_trie.prefix_trie(chats.where("false")).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    without = next(c for c in range(1, 100) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    rows = [(without, 0, "user", "gone")]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, CHATS)).collect()
    assert [tuple(r) for r in got] == [(without, 0, None, 1, 0, 1, 0, hashlib.sha256(str(without).encode()).hexdigest())]


# ------------------------------------------------------------------ tiers


def check_tiers(out, rows):
    encoder = byte_encoder(True)
    want = Counter()
    for doc, text in rows:
        want[doc, tuple([*encoder.encode(text or "", add_special_tokens=False).ids, 0])] += 1
    by_seq, tokens, steps = defaultdict(list), 0, defaultdict(Counter)
    for r in out:
        by_seq[r.sequence_id].append(r)
        tokens += r.length
    assert tokens == sum(len(ids) * n for (_, ids), n in want.items())
    for own in by_seq.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0 and at == own[0].tier and len({(r.tier, r.step) for r in own}) == 1
        steps[own[0].step][at] += 1
    for tier in tiered_packing.TIERS:
        each = [n[tier] for n in steps.values()]
        assert max(each) - min(each) <= 1
    single = {doc: ids for (doc, ids), n in want.items() if n == 1 and sum(d == doc for d, _ in want) == 1}
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
    for doc, ids in single.items():
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length]))
            at += r.length
        assert at == len(ids)
    for doc in pieces.keys() - single.keys():
        assert sum(r.length for r in pieces[doc]) == sum(len(ids) * n for (d, ids), n in want.items() if d == doc)


def test_tiers_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = queries.op13_tiered_packing(spark, SMALL).collect()
    check_tiers(out, rows)
    assert Counter(r.tier for r in out).keys() >= {1024, 512, 256, 128}


def test_tiers_awkward_rows(spark):
    docs = awkward(spark).union(docs_of(spark, [(30, "a <|endoftext|> b", "en", "a"), *[(31 + i, "x y z", "en", "a") for i in range(50)]]))
    out = tiered_packing.pack_tiers(clashing(docs), BYTE, step_tokens=4096)
    assert out.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_tiers(out.collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert tiered_packing.pack_tiers(empty(spark), BYTE).count() == 0
    assert [tuple(r)[:5] for r in tiered_packing.pack_tiers(docs_of(spark, [(1, None, "en", "a")]), BYTE).collect()] == [
        (1, 0, 1, zlib.crc32(b"\0\0\0\0"), 1)]
    with pytest.raises(ValueError):
        tiered_packing.pack_tiers(docs, BYTE, tiers=(1000,))


@pytest.mark.parametrize("seed", range(12))
def test_plans_lose_nothing(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 1024), rng.choice([1, 2, 5, 200, 1023]))
    histogram = {n: rng.choice([1, 2, 3, rng.randrange(1, 10 ** rng.randrange(1, 8))]) for n in lengths}
    plan = tiered_packing.Plan(histogram)
    assert len(plan.done) < 20 * len(lengths) + 20          # grows with the lengths, not with the documents
    assert sum(len(w.lots) for w in plan.done) < 100 * len(lengths) + 1100
    covered = defaultdict(list)
    for w in plan.done:
        assert sum(x.size for x in w.lots) == w.tier and w.tier & (w.tier - 1) == 0 and all(x.count * x.each == w.count for x in w.lots)
        for x in w.lots:
            covered[x.length].append((x.first, x.first + x.count, x.at, x.size))
    assert sum(w.tier * w.count for w in plan.done) == sum(n * k for n, k in histogram.items())
    places = tiered_packing.Places.of(plan, {})
    for n, k in histogram.items():
        for rank in {0, k - 1, k // 2, *[min(k - 1, x) for lo, hi, _, _ in covered[n][:5] for x in (lo, hi)]}:
            at = 0
            for start, size, *_ in places.find(n, rank):
                assert start == at
                at += size
            assert at == n
    assert sum(w.count for w in plan.done if w.tier < 128) <= 10
