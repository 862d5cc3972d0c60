import math
import random
import re
from collections import Counter

import pytest
from compare import connect, difference
from conftest import SMALL
from helpers import awkward, clashing, docs_of, empty, sentence

from herdcast.llm import mixing, quality_rules, queries


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_matches_sql(spark, name):
    assert difference(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name]) is None


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    inside = {i + k for i, g in enumerate(windows) if times[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside),
            len(w) < 50 or 100 * len(inside) > 50 * len(w))


def test_base_counts(spark):
    rng = random.Random(1)
    text = sentence(rng, 30)
    extra = docs_of(spark, [(20, f"{text} {text}", "en", "a"), (21, "a b c a b c a b c", "en", "a"), (22, "x\ny\nx\n\n x\nx", "en", "a"),
                            (23, " ".join(["a b"] * 50), "en", "a"), (24, "## | $$ " * 20 + text, "en", "a")])
    for df in (awkward(spark).union(extra), clashing(awkward(spark).union(extra))):
        texts = df.select("doc_id", df.columns[1]).toDF("doc_id", "text") if "TEXT" not in df.columns else None
        out = quality_rules.quality_rules(df).collect()
        if texts is not None:
            want = Counter((r.doc_id, *base(r.text)) for r in texts.collect())
        assert Counter(tuple(r)[:7] for r in out) == want
        assert not any(r.kept and r.base_failed for r in out)
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_order_does_not_change_the_verdict(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = quality_rules.apply_rules(df, quality_rules.RULES)
    two = quality_rules.apply_rules(df, quality_rules.RULES[::-1])
    assert one.exceptAll(two).count() == 0
    assert sorted(r.name for r in quality_rules.order_rules(df)) == sorted(r.name for r in quality_rules.RULES)


def test_good_text_is_kept(spark):
    rng = random.Random(2)
    assert quality_rules.quality_rules(docs_of(spark, [(i, sentence(rng, 120), "en", "a") for i in range(20)])).where("kept").count() == 20


def test_rates_and_counts(spark):
    rng = random.Random(4)
    rows = [(i, "x" * 10, "en", "big" if i % 3 else "small") for i in range(3000)] + [(i, "y" * 100, "en", "tiny") for i in range(3000, 3003)]
    rng.shuffle(rows)
    df = docs_of(spark, rows)
    out = mixing.mix_sources(df, weights={"big": 0.25, "small": 0.5, "tiny": 0.25})
    got = Counter(r.source for r in out.collect())
    chars = 30_300
    for name, weight, size in (("big", 0.25, 10), ("small", 0.5, 10), ("tiny", 0.25, 100)):
        mean = weight * chars / size
        assert abs(got[name] - mean) < 5 * math.sqrt(mean)
    per_doc = Counter(r.doc_id for r in out.where("source = 'tiny'").collect())
    assert set(per_doc) <= {3000, 3001, 3002} and max(per_doc.values()) > 10          # rates above one part
    keys = [r.order_key_ for r in out.collect()]
    assert keys == sorted(keys)


def test_mixing_awkward_rows(spark):
    df = awkward(spark)
    out = mixing.mix_sources(df)
    assert out.columns == [*df.columns, "copy_", "order_key_"]
    rows = out.where("doc_id = 8").collect()
    assert len(rows) % 2 == 0                                     # repeated rows share their count
    again = mixing.mix_sources(clashing(df).drop("copy_"))
    assert again.count() == out.count()
    assert mixing.mix_sources(empty(spark)).count() == 0
    assert mixing.mix_sources(df, weights={"nowhere": 1.0}).count() == 0
