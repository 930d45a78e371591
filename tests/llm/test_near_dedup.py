"""Near copies that closer texts, larger components or another threshold would hide."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from ratescope.llm import near_dedup
from tests.llm import brute


def crowd(n: int, odd: tuple[int, int]) -> list[tuple[int, str]]:
    """Texts that differ from one base in some words each, so that many pairs lie on both sides of the threshold."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(0, 300, 5), rng.randint(*odd)):
            words[at] = f"odd{i}x{at}"
        texts.append((i, " ".join(words)))
    return texts


def components(spark, docs, similar):
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    return {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(table, similar).collect()}


@pytest.mark.parametrize(("similar", "odd"), [(85, (1, 4)), (80, (2, 6))])
def test_crowded_region_equals_all_pairs(spark, monkeypatch, similar, odd):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 40, raising=False)
    docs = crowd(150, odd)
    expected = brute.near_components(docs, similar)[0]
    assert 1 < len(set(expected.values())) < 100
    assert components(spark, docs, similar) == expected


def test_pipeline_stage_drops_copies_from_80_percent(spark, tmp_path):
    docs = crowd(60, (2, 4))
    component = brute.near_components(docs, 80)[0]
    assert component != brute.near_components(docs, 85)[0]
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = stage(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), str(tmp_path)).collect()
    assert {r["doc_id"] for r in kept} == {i for i, c in component.items() if i == c}
