"""The corpus pipeline, stage by stage, against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from ratescope.llm.common import read_table, write_stage
from tests.llm import brute, fixture


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return fixture.write(spark, str(tmp_path_factory.mktemp("pipeline")))


def key(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_stages_act_on_what_came_before(spark, folder):
    docs = read_table(spark, folder, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = write_stage(stage(spark, docs, folder), f"test-{name}")
        after = docs.collect()
        pairs = [(r["doc_id"], r["text"]) for r in before]
        if name != "mixing":
            assert docs.columns == columns
            assert all(r["text"] is None or r["n_chars"] == len(r["text"]) or r["doc_id"] is None for r in after)
        if name == "quality_rules":
            failed = {(i, n) for i, n, *_, bad in brute.quality_base(pairs) if bad}
            assert not failed & {(r["doc_id"], len(brute.WORD.findall(r["text"] or ""))) for r in after}
            assert {0, 7, 60, 95} <= {r["doc_id"] for r in after} and not {90, 91, 94, 99} & {r["doc_id"] for r in after}
        elif name == "line_dedup":
            assert Counter((r["doc_id"], brute.sha(r["text"] or "")) for r in after) == Counter((i, d) for i, _, _, d in brute.line_dedup(pairs))
        elif name == "near_dedup":
            component, _ = brute.near_components(pairs)
            assert key(after) == key(r for r in before if r["doc_id"] is None or component[r["doc_id"]] == r["doc_id"])
        elif name == "decontamination":
            hit = {(i, n) for i, n, k, *_ in brute.decontamination(pairs, [r[:2] for r in fixture.BENCHMARK]) if k}
            text = {r["doc_id"]: r["text"] for r in after}
            assert 98 in text and "harbours" not in text[98]
            clean = [r for r in before if (r["doc_id"], len(brute.TOKEN.findall(r["text"] or ""))) not in hit]
            assert not key(clean) - key(after)
        else:
            assert set(docs.columns) == {*columns, "copy"} - {"copies"} | ({"copies"} & set(docs.columns))
            assert max(Counter((r["doc_id"], r["text"]) for r in after).values()) <= 4
            assert {r["doc_id"] for r in after} <= {i for i, _ in pairs}


def test_run_is_all_stages(spark, folder):
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect())


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, fixture.write_empty(spark, str(tmp_path))).count() == 0
