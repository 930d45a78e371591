"""Clustering, hard negatives and URL rules against plain Python, with parameters that cut blocks and portions small."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratescope.llm import centroid_clustering, hard_negatives, url_filter
from ratescope.llm.queries import QUERIES, URL_RULES
from tests.llm import brute, fixture


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return fixture.write(spark, str(tmp_path_factory.mktemp("vectors")))


def rows(df, columns: str):
    return Counter(tuple(r[c] for c in columns.split()) for r in df.collect())


CLUSTER = "vec_id cluster distance cluster_inertia inertia centroid_sha256"
NEGATIVE = "anchor_id positive_id rank negative_id positive_score negative_score"


def test_clustering(spark, folder):
    got = rows(QUERIES["op11_centroid_clustering"](spark, folder), CLUSTER)
    assert got == Counter(brute.clustering([r[:2] for r in fixture.embeddings()]))
    assert any(r[0] is None for r in got)


def test_clustering_with_fewer_rows_than_centroids_and_further_columns(spark, folder):
    few = spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id < 30")
    done = centroid_clustering.cluster(few, pivots=3)
    assert done.columns == ["vec_id", "embedding", "label", "anchor", "score", *centroid_clustering._ADDED]
    assert rows(done, CLUSTER) == Counter(brute.clustering([r[:2] for r in fixture.embeddings() if r[0] is not None and r[0] < 30]))


@pytest.mark.parametrize("flat", [0, 1, 3, 64])
def test_bounds_never_exclude_the_nearest(flat):
    """Vectors within a few dimensions, so that pivots nearly lie in each other's span; large and small ones."""
    rng = np.random.default_rng(flat)
    axes = rng.normal(size=(flat, 64))
    for scale in (1, 300, 200_000):
        points = np.floor(scale * (rng.normal(size=(300, flat)) @ axes) + rng.integers(-1, 2, size=(300, 64))).astype(np.int64)
        pivots = centroid_clustering.Pivots.chosen(points[:40])
        held = centroid_clustering.Centroids.over(points[:40], pivots)
        numbers, distances, compared = held.nearest(points, pivots.apexes(points))
        exact = ((points[:, None, :] - points[None, :40]) ** 2).sum(axis=2)
        assert (numbers == exact.argmin(axis=1)).all() and (distances == exact.min(axis=1)).all()
        assert len(points) <= compared <= exact.size


def test_bounds_exclude_far_centroids():
    rng = np.random.default_rng(1)
    centres = rng.integers(-1000, 1000, size=(40, 64))
    points = centres[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, size=(2000, 64))
    pivots = centroid_clustering.Pivots.chosen(centres)
    held = centroid_clustering.Centroids.over(centres, pivots)
    assert held.nearest(points, pivots.apexes(points))[2] < 0.25 * len(points) * len(centres)


def test_hard_negatives(spark, folder):
    source = [(i, v, lab if lab is None or i is None or i % 7 else (lab + 1) % 10) for i, v, lab, *_ in fixture.embeddings()]
    expected = Counter(brute.hard_negatives(source))
    assert rows(QUERIES["op13_hard_negatives"](spark, folder), NEGATIVE) == expected
    assert len({r[0] for r in expected}) >= 4


def test_hard_negatives_of_all_rows_in_small_blocks_and_portions(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id is not null")
    source = [r[:3] for r in fixture.embeddings() if r[0] is not None]
    got = hard_negatives.mine(df, F.col("vec_id") % 2 == 0, block=7, portion_bytes=20_000)
    expected = Counter(brute.hard_negatives(source, every=2))
    assert rows(got, NEGATIVE) == expected and any(n > 1 for n in expected.values())


def test_spanning_tree_bounds_spare_scores():
    """Children close to their parents: most rows' bounds stay below the window, and none that reaches it is missed."""
    rng = np.random.default_rng(2)
    anchors = (rng.integers(-100, 100, 64) + rng.integers(-3, 4, size=(50, 64))).astype(np.int32)
    data = rng.integers(-100, 100, size=(3000, 64)).astype(np.int32)
    order, parents, edges, levels = hard_negatives.spanning_tree(anchors)
    tree = hard_negatives.Tree(0, np.arange(50), np.zeros(50, np.int64), anchors[order], parents, edges, levels)
    exact = anchors[order].astype(np.int64) @ data.T.astype(np.int64)
    least = np.sort(exact, axis=1)[:, -5]
    norms = np.sqrt((data.astype(float) ** 2).sum(axis=1))
    seen = {p: (set(r.tolist()), s) for p, r, s in hard_negatives._scored(tree, data, norms, lambda places, low, high: high >= least[places][:, None])}
    assert sum(len(r) for r, _ in seen.values()) < 0.2 * exact.size
    for place in range(50):
        assert set(np.flatnonzero(exact[place] >= least[place]).tolist()) <= seen[place][0]


def test_url_filter(spark, folder):
    df = spark.createDataFrame([(n, u, "old", 3) for n, u in enumerate(fixture.URLS * 2)], "page_id int, url string, verdict string, host int")
    done = url_filter.judge(df, spark.createDataFrame(URL_RULES, url_filter.RULES))
    assert done.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert rows(done, "page_id host path rule verdict") == Counter((n, *r) for n, r in enumerate(brute.url_rules(fixture.URLS * 2, URL_RULES)))
    query = QUERIES["op12_url_filter"](spark, folder)
    assert rows(query, "page_id host path rule verdict") == Counter((p[0], *r) for p, r in zip(fixture.PAGES, brute.url_rules([p[1] for p in fixture.PAGES], URL_RULES)))


def test_url_filter_with_thousands_of_rules_in_a_crowded_filter(spark, monkeypatch):
    """One block for all keys: nearly everything passes the filter, and the join removes what is not listed."""
    rng = random.Random(5)
    names = [a + b for a in "abcdefgh" for b in "xyz"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randint(2, 4)))
    path = lambda: "/" + "".join(rng.choice("/ab") for _ in range(rng.randint(2, 6)))
    rules = list({(host(), path()): None for _ in range(3_000)})
    rules = [(h, p, "block" if rng.random() < 0.5 else "allow") for h, p in rules]
    urls = [f"http://{host()}{path()}" for _ in range(2_000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    expected = Counter((n, *r) for n, r in enumerate(brute.url_rules(urls, rules)))
    assert sum(r[3] is None for r in expected) > 50
    listed = spark.createDataFrame(rules + [(None, "/", "block"), ("x", None, "block")] + rules[:5], url_filter.RULES)
    assert rows(url_filter.judge(df, listed), "page_id host path rule verdict") == expected
    monkeypatch.setattr(url_filter.BlockedBloom.__init__, "__defaults__", (1,))
    assert rows(url_filter.judge(df, listed), "page_id host path rule verdict") == expected


def test_no_rules_allow_everything(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id int, url string")
    got = url_filter.judge(df, spark.createDataFrame([], url_filter.RULES))
    assert rows(got, "page_id host path rule verdict") == Counter([(1, "a.com", "/", None, "allow"), (2, "", "", None, "allow")])
