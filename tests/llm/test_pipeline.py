"""The pipeline against the brute-force reading of each stage, on its own input."""

from collections import Counter

import pytest
from conftest import SMALL
from test_jaccard_join import brute

import corpus_pipeline
from herdcast.llm import importance, language_id, mixing
from herdcast.llm.common import materialise, table


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, SMALL, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SMALL), name))
    return out


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "near_duplicates", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(stages[-1].columns)


def test_filters_follow_their_operators(spark, stages):
    judged = language_id.identify(stages[0], language_id.fit(stages[0], held_out=None)).where("NOT rejected").select("doc_id")
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in judged.collect()}
    sampled = importance.classify(stages[1], table(spark, SMALL, "labels")).where("kept").select("doc_id")
    assert {r.doc_id for r in stages[2].collect()} == {r.doc_id for r in sampled.collect()}
    assert not rows(stages[1]) - rows(stages[0]) and not rows(stages[2]) - rows(stages[1])


def test_one_of_each_group(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted({c for _, _, c in brute(before, 5, 80)})


def test_mix_and_pack(stages):
    assert rows(stages[4]) == rows(mixing.mix_sources(stages[3]).select(*stages[3].columns))
    first = Counter(r.doc_id for r in stages[5].where("piece = 0").collect())
    assert first == Counter(r.doc_id for r in stages[4].collect())


def test_run_gives_the_last_stage(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages[-1].count()
