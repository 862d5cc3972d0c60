import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, clashing, docs_of, empty, sentence

from herdcast.llm import jaccard_join as J
from herdcast.llm.graph import components


def brute(rows, width=3, percent=90):
    """Links by counting every shared shingle; components over doc_ids."""
    sets = {}
    for at, (doc, text, *_) in enumerate(rows):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[at] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    parent = {at: at for at in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, common = defaultdict(list), Counter()
    for at, s in sets.items():
        if rows[at][0] is not None:
            for g in s:
                where[g].append(at)
    for ats in where.values():
        common.update((a, b) for i, b in enumerate(ats) for a in ats[:i])
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            parent[root(a)] = root(b)
    least = {}
    for at in sets:
        if rows[at][0] is not None:
            r = root(at)
            least[r] = min(least.get(r, rows[at][0]), rows[at][0])
    return sorted(((rows[at][0], len(s), None if rows[at][0] is None else least[root(at)]) for at, s in sets.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies(rng, groups, rates):
    rows = []
    for size, words in groups:
        base = sentence(rng, words).split()
        for _ in range(size):
            rate = rng.choice(rates)
            text = [sentence(rng, 1) if rng.random() < rate else w for w in base]
            rows.append((len(rows), " ".join(text[:len(text) - rng.randrange(3)]), "en", "a"))
    ids = rng.sample(range(10_000), len(rows))
    return [(i, *r[1:]) for i, r in zip(ids, rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force_on_near_copies(spark, seed):
    rng = random.Random(seed)
    rows = near_copies(rng, [(60, 200), (40, 90), (25, 30), (20, 14), (20, 11), (15, 8), (10, 3), (8, 2)] + [(3, rng.randrange(1, 120)) for _ in range(30)],
                       [0, 0.003, 0.01, 0.02, 0.03, 0.05])
    assert got(J.jaccard_join(docs_of(spark, rows))) == brute(rows)


def test_other_thresholds(spark):
    rows = near_copies(random.Random(5), [(25, 100), (20, 20), (10, 6)], [0, 0.02, 0.05, 0.1])
    join = J.Join(width=5, percent=80, fragments=3)
    assert got(J.jaccard_join(docs_of(spark, rows), join)) == brute(rows, 5, 80)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(J.jaccard_join(df)) == brute(rows)
    assert got(J.jaccard_join(clashing(df))) == brute(rows)
    assert J.jaccard_join(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = near_copies(random.Random(7), [(10, 100), (5, 30)], [0, 0.01]) + [(20_000, None, "en", "a"), (None, "a b c", "en", "a")]
    df = docs_of(spark, rows + rows[:2])
    kept = J.deduplicate(df)
    assert kept.columns == df.columns
    want = {c for d, _, c in brute(rows) if d is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(100) if i != 50] + [(200, 7), (300, 300)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert out == {**{i: 0 for i in range(51)}, **{i: 51 for i in range(51, 101)}, 200: 0}


def test_sets_of_odd_texts():
    rng = random.Random(9)
    long = "y" * 64
    texts = [None, "", " \n\t\x0b\x0c\r ", "word", " a b", "A b c ", "a b C\n", "a b c a b c", long, long + "z", "y" * 1000, "ÀB à\u3000b \x1c c",
             *["".join(rng.choice("ab \n\tÄC\x0b") for _ in range(rng.randrange(80))) for _ in range(500)]]
    for kind in (pa.string(), pa.large_string()):
        for width in (1, 3):
            found = J.shingles(pa.array(["before", *texts], kind).slice(1), width)
            names = {}
            for text, s in zip(texts, found, strict=True):
                w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
                want = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
                assert len(s) == len(want) and (s[1:] > s[:-1]).all()
                assert names.setdefault(want, s.tobytes()) == s.tobytes()
            assert len(set(names.values())) == len(names)
            assert len(set(zip(*(d.tolist() for d in J.digests(found)), strict=True))) == len(names)


def test_histograms_rule_out_near_copies_that_do_not_link():
    rng, join = np.random.default_rng(4), J.Join()
    lows = join.bounds(4000)
    for _ in range(20):
        common = rng.integers(0, 2 ** 64, 800, dtype=np.uint64)
        one, two = (np.sort(np.concatenate([common, rng.integers(0, 2 ** 64, 54, dtype=np.uint64)])) for _ in range(2))
        (_, (x, _)), (_, (y, _)) = (J._histograms(s, join, lows) for s in (one, two))
        assert np.abs(x.astype(int) - y.astype(int)).sum() > join.largest_difference(len(one) + len(two))


def test_only_likely_texts_are_shuffled(spark):
    rows = [(i, f"text {i}", "en", "a") for i in range(3000)] + [(7, "again", "en", "a"), (None, "no id", "en", "a"), (-(2 ** 62), "far", "en", "a")]
    docs = docs_of(spark, rows)
    kept = J._likely(docs, spark.createDataFrame([(7,), (2999,), (7,), (-(2 ** 62),), (10 ** 12,)], "doc_id long"))
    assert kept.columns == docs.columns
    out = Counter(r.text for r in kept.collect())
    assert not Counter(["text 7", "again", "text 2999", "far"]) - out and out.total() < 20
    assert J._likely(docs, spark.createDataFrame([], "doc_id long")).count() == 0


@pytest.mark.parametrize("join", [J.Join(), J.Join(width=5, percent=80)])
def test_linked_sets_meet_often_enough(spark, join):
    """However the differences fall, down to one fragment each, linked sets have as many keys in common as is asked of them."""
    rng, lows = np.random.default_rng(6), join.bounds(1 << 12)
    sizes, shared = [], []
    for n in [*range(1, 60), 90, 150, 400, 1200]:
        base = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        parts = J._part(base, 8 * n)
        base = base[np.argsort(rng.permutation(8 * n)[parts.astype(int)])]        # what is dropped lies in as many fragments as it can
        for dropped in range(n):
            one, two = np.sort(base), np.sort(base[dropped:])
            if 100 * len(two) < join.percent * len(one):
                break
            if dropped:
                sizes.append((len(one), len(two)))
                shared.append(len(np.intersect1d(J._fine_keys(one, join, lows), J._fine_keys(two, join, lows))))
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(sizes)], "i long, large long, small long")
    least = df.select("i", *[J._least_shared(*a, join, larger=b).alias(c) for *a, b, c in
                             [("small", 1200, True, "p"), ("small", 1200, False, "x"), ("large", 1200, False, "y")]]).orderBy("i").collect()
    assert all(s >= max(r.p, r.x, r.y) for s, r in zip(shared, least, strict=True)) and max(r.p for r in least) > 5


def test_texts_that_meet_by_chance_are_not_fetched(spark, monkeypatch):
    """Long texts with a passage in common agree on a fragment here and there, too seldom to link."""
    rng, fetched = random.Random(11), []
    passage = [f"p{rng.randrange(10 ** 9)}" for _ in range(60)]
    rows = [(i, " ".join([f"w{rng.randrange(10 ** 9)}" for _ in range(340)] + passage), "en", "a") for i in range(20)]
    rows += [(100 + i, rows[i][1] + " end", "en", "a") for i in range(2)]

    def counted(df, what, own=J.materialise):
        out = own(df, what)
        if what == "segments":
            fetched.append(out.select("rep").distinct().count())
        return out
    monkeypatch.setattr(J, "materialise", counted)
    assert got(J.jaccard_join(docs_of(spark, rows), J.Join(width=5, percent=80))) == brute(rows, 5, 80)
    assert fetched[0] < 10
