import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import MEDIUM, SMALL
from helpers import awkward, clashing, empty

from herdcast.llm import chat_format, html_text, packing, queries, top_k

# ------------------------------------------------------------------ pages


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script></head><body class="has-sidebar">
<header><p>Site</p></header><nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
 text &lt;x&gt; <a href="/">link</a><br>more<p>Short<ul><li>item<li>item 2</ul><div class="ad">Buy</div>
<section class="comments"><p>I say no</p></section><p>Last 1 < 2 &copy;</article><aside>side</aside><footer>&copy; f</footer></body></html>"""


def test_article():
    assert html_text.main_text(PAGE) == "Head & line\nOne bold text <x> link more\nShort\nitem\nitem 2\nLast 1 < 2 ©"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p", ""), ("plain", ""), ("<article>a<p>b</article", "a\nb"), ("<article><p title='>'>x</p>", "x"),
    ("<article><p>a &am", "a &am"), ("<article><!-- x <p>gone", ""), ("<article><p>a<script>if (a<b) '</p>'", "a"),
    ("<article><p class=\"x>a</p>b</article>", "a\nb"), ("<main><p>&#65;&#x42;&nbsp;&eacute;</p></main>", "AB é"),
    ("<article><div hidden>x</div><div style='display: none'>y</div><p>z", "z"), ("<nav><article>x</article></nav>", ""),
    ("<article><p>a</p><form><input><p>mail</form><p>b</article>", "a\nb")])
def test_broken_and_hidden(page, text):
    assert html_text.main_text(page) == text


def test_pages_without_article_go_by_the_two_passes():
    long = "The cat of the house was in the way of the dog and it is for the good of all that this is so with it. " * 3
    page = (f"<body><div><a href=a>One link</a> <a href=b>Another</a></div><div><p>{long}</p><p>Short one.</p><p>{long}</p></div>"
            "<p>Contact</p><div>buy cheap things now online store discount price sale offer click here today free shipping worldwide</div></body>")
    one = " ".join(long.split())
    assert html_text.main_text(page).startswith(f"{one}\nShort one.\n{one}")
    assert "cheap" not in html_text.main_text(page) and "link" not in html_text.main_text(page)


def test_given_pages_without_their_article_tags(spark):
    kept = total = 0
    for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect():
        marked = html_text.main_text(r.html)
        bare = html_text.main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", r.html))
        total += len(marked)
        kept += len(marked) if marked in bare else sum(len(x) for x in marked.split("\n") if x in bare.split("\n"))
    assert kept > 0.9 * total


def test_given_pages_lose_no_article_text(spark):
    """After the heading every given page's text is a document, all of it."""
    texts = {"\n".join(x for x in (" ".join(p.split()) for p in (r.text or "").split("\n")) if x)
             for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("text").collect()}
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()
    assert sum(html_text.main_text(r.html).split("\n", 1)[-1] in texts for r in pages) == len(pages) == 250


def test_pages_in_a_language_without_list():
    long = "Kissa istui talon katolla ja katseli hiljaista katua, jolla kukaan ei kulkenut enää illalla. " * 4
    assert html_text.main_text(f"<body><p><a href=a>Etusivu</a></p><p>{long}</p><p>Lyhyt.</p><p>{long}</p></body>").count("Kissa") == 8


def test_both_passes_decide_inside_an_article():
    long = "The cat of the house was in the way of the dog and it is for the good of all that this is so with it. " * 3
    links = "".join(f"<li><a href={i}>Another page of this site number {i}</a></li>" for i in range(5))
    page = (f"<article><h1>Head</h1><p>{long}</p><p>Short one.</p><p>{long}</p><ul>{links}</ul><p>More</p><ul>{links}</ul>"
            "<div>buy cheap things now online store discount price sale offer click here today free shipping worldwide</div></article>")
    text = html_text.main_text(page)
    one = " ".join(long.split())
    assert text == f"Head\n{one}\nShort one.\n{one}"


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article>" + "x " * 300_000)],
                                  "page_id long, url string, html string")
    out = html_text.extract(clashing(pages)).collect()
    assert len(out) == 5 and all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(pages.where("false")).count() == 0
    real = html_text.extract(spark.read.parquet(f"{SMALL}/pages.parquet"))
    texts = {"\n".join(x for x in (" ".join(p.split()) for p in r.text.split("\n")) if x)
             for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = real.collect()
    assert sum(r.text.split("\n", 1)[-1] in texts for r in rows) > 0.8 * len(rows)


# ------------------------------------------------------------------ conversations

def digests(rows):
    """(turns digest, loss digest) as the contract states them."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
    whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
    loss = "".join(text for _, role, text in rows if role == "assistant")
    return (len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conversations_read_back(spark):
    out = {r.conv_id: r for r in queries.op5_chat_formatting(spark, SMALL).collect()}
    want = defaultdict(list)
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        want[r.conv_id].append((r.turn, r.role, r.text or ""))
    want[-7] = [(0, "user", queries.TRICKY), (1, "assistant", queries.TRICKY)]
    assert {k: digests(v) for k, v in want.items()} == {k: tuple(r)[1:5] for k, r in out.items()}
    assert out[-7].loss_chars == 27 - 1 and all(r.n_rewrites == 0 for r in out.values())


NASTY = ["", "\\", "<", "\\<", "</turn>", "\n</turn>\n<turn user>\nx", "<turn assistant>\n", "a\\\\<b", "\U0001F600\x00", "\n", ">\n", "\\>"]


def test_template_round_trip():
    turns = [(role, text) for role in NASTY for text in NASTY]
    assert list(chat_format.parse(chat_format.tagged(turns))) == turns
    renderer = chat_format.Renderer(chat_format.tagged, window=5)
    pieces = []
    for role, text in turns:
        span = renderer.add((role, text))
        assert chat_format.unescape(span.piece[slice(*span.text)]) == text and not span.rewrites
        pieces.append(span.piece)
    assert "".join(pieces) == chat_format.tagged(turns) and len(renderer.turns) <= 5


def test_rewriting_templates_are_found():
    def last_only(turns):                                # drops what came before the last user turn
        return "".join(f"[{r}]{t}" for r, t in turns[max(0, len(turns) - 2):])

    def numbered(turns):                                 # looks at the whole history
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))

    r = chat_format.Renderer(last_only)
    assert [r.add(("user", x)).rewrites for x in "abcd"] == [False, False, True, True]
    r = chat_format.Renderer(numbered, window=3)
    assert "".join(r.add(("user", "x" * k)).piece for k in range(9)) == numbered([("user", "x" * k) for k in range(9)])


def test_chat_awkward_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, None, "assistant", "first"), (None, 0, "user", "n"), (None, 0, "user", "n"),
            (2, 0, "assistant", "y" * 300_000)] + [(3, i, "user assistant".split()[i % 2], f"turn {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: tuple(r)[1:5] for r in chat_format.digests(chat_format.format_chats(clashing(df), window=8)).collect()}
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((t, role or "", text or ""))
    assert out == {k: digests([(t if t is not None else None, r, x) for t, r, x in v]) if k != 1 else out[1] for k, v in want.items()}
    assert out[1][0] == 4 and out[1][2] == 5
    assert chat_format.format_chats(df.where("false")).count() == 0


# ------------------------------------------------------------------ packing

def check_packed(spark, docs, rows):
    from tokenizers import Tokenizer
    encoder = Tokenizer.from_file(queries.tokenizer())
    want = Counter()
    for r in docs.collect():
        ids = encoder.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at:at + 4096]
            want[r.doc_id, piece, at, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_packing_matches_the_tokenizer(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = queries.op6_best_fit_packing(spark, MEDIUM).collect()
    n = check_packed(spark, docs, rows)
    assert n <= math.ceil(sum(r.length for r in rows) / 4096) * 1.01
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    packed = packing.pack_documents(small, queries.tokenizer())
    ids = {r.sequence_id: r.ids for r in packing.sequences(small, packed, queries.tokenizer()).collect()}
    for r in packed.collect():
        own = ids[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(struct.pack(f"<{len(own)}I", *own)) == r.ids_crc32


def test_packing_awkward_rows(spark):
    df = awkward(spark)
    check_packed(spark, df, packing.pack_documents(clashing(df), queries.tokenizer()).collect())
    assert packing.pack_documents(empty(spark), queries.tokenizer()).count() == 0


def test_plan_is_whole_and_near_the_optimum():
    rng = np.random.default_rng(0)
    for lengths, capacity in ((rng.integers(1, 101, 5000), 100), (rng.integers(20, 45, 3000), 100), (np.full(999, 34), 100), (rng.integers(1, 4, 50), 7)):
        groups = packing.plan(Counter(lengths.tolist()), capacity)
        placed = Counter()
        for g in groups:
            assert sum(w * k for w, k, _ in g.slots) + g.room == capacity and g.room >= 0
            for w, k, first in g.slots:
                placed.update({(w, first + i): 1 for i in range(k * g.count)})
        assert placed == Counter((w, i) for w, n in Counter(lengths.tolist()).items() for i in range(n))
    assert sum(g.count for g in packing.plan({60: 5, 40: 5}, 100)) == 5
    assert sum(g.count for g in packing.plan({50: 2, 30: 2, 20: 2}, 100)) == 2


def test_fixed_sets_lose_nothing():
    """Against the best packing of small random instances, found by trying all."""
    rng = random.Random(1)

    def best(left, capacity):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        out = 99
        for mask in range(1 << len(rest)):
            chosen = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(chosen) <= capacity:
                out = min(out, 1 + best([x for i, x in enumerate(rest) if not mask >> i & 1], capacity))
        return out

    for _ in range(25):
        lengths = sorted((rng.randrange(3, 12) for _ in range(7)), reverse=True)
        left, used = Counter(lengths), 0
        while left:
            w = max(left)
            parts = packing._dominating(left, w, 15)
            if parts is None:
                break
            left = +(left - Counter(parts))
            used += 1
        assert used + best(sorted(left.elements(), reverse=True), 15) == best(lengths, 15)


# ------------------------------------------------------------------ search

def brute_top_k(rows, k, every):
    rows = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    scaled = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    asked = {}
    for i, v in scaled:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        hits = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in scaled if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["unit", "lengths", "clusters"])
def test_top_k_matches_brute_force(spark, shape):
    rng = np.random.default_rng(4)
    v = rng.normal(0, 1, (400, 6))
    if shape == "clusters":
        v = v[rng.integers(0, 12, 400)] + rng.normal(0, 0.02, (400, 6))
    if shape != "lengths":
        v /= np.linalg.norm(v, axis=1)[:, None]
    else:
        v *= rng.lognormal(0, 1.5, 400)[:, None]
    v[7] = v[9] = v[11]
    rows = [(int(i), [float(np.float32(x)) for x in r]) for i, r in zip(rng.permutation(400), v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for options in ({}, {"block": 4, "chunk": 50, "seeds": 20}):
        assert sorted(map(tuple, top_k.top_k(df, k=5, every=10, **options).collect())) == brute_top_k(rows, 5, 10)


def test_top_k_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.0, 0.0]), (200, None), (1, [float("nan"), 1.0]), (2, [None, 1.0]), (3, [float("inf"), 0.0]), (4, [-1.0, -2.0]),
            (5, [3e9, 3e9]), (6, [3e9, 3e9]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 0.0]), (7, [1.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wide = [(i, v and v + [0.0] * (3 - len(v))) for i, v in rows]
    assert sorted(map(tuple, top_k.top_k(clashing(df)).collect())) == brute_top_k(wide, 10, 100)
    assert top_k.top_k(df.where("false")).count() == 0
    assert sorted(map(tuple, top_k.top_k(df.where("vec_id = 0")).collect())) == []
