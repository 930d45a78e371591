"""Exact percentiles: the distributed path against Spark's aggregate and against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratescope.operators.percentiles import hot_groups, percentiles_by_group

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def skewed_rows(seed: int, n: int = 3_000):
    """One key holds a third of all rows, many values repeat, some are NULL, some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        value = rng.choice([None, 0.01, -5.0, 100.0, rng.uniform(-1e3, 1e6), round(rng.uniform(20_000, 20_010), 2)])
        rows.append((key, i % 2, value))
    rows += [("empty", 0, None)] * 50
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [10, 700, 10**9])
def test_same_as_numpy(spark, seed, limit):
    rows = skewed_rows(seed)
    df = spark.createDataFrame(rows, "k string, m int, v double")
    found = percentiles_by_group(
        df, ["k"], {"all": (F.col("v"), PROBS), "odd": (F.when(F.col("m") == 1, F.col("v")), [0.5])},
        [F.count("*").alias("n")], limit=limit,
    )
    got = {r["k"]: r for r in found.collect()}
    assert set(got) == {"hot", "a", "b", None, "empty"}
    for key, row in got.items():
        values = [v for k, _, v in rows if k == key and v is not None]
        odd = [v for k, m, v in rows if k == key and m == 1 and v is not None]
        assert row["n"] == sum(k == key for k, _, _ in rows)
        if not values:
            assert row["all"] is None and row["odd"] is None
            continue
        assert row["all"] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12, abs=1e-9)
        assert row["odd"] == pytest.approx([np.quantile(odd, 0.5)], rel=1e-12, abs=1e-9)


def test_infinity_and_nan_rank_as_in_the_aggregate(spark):
    values = [(1, v) for v in (math.inf, -math.inf, math.nan, 1e308, -1e308, 0.0, -0.0, 1.0)]
    df = spark.createDataFrame(values, "k int, v double")
    # Positions 0, 1, ... are whole ranks, so nothing is interpolated with an infinity.
    probs = [i / 7 for i in range(8)]
    near = percentiles_by_group(df, ["k"], {"p": (F.col("v"), probs)}, limit=100).first()["p"]
    far = percentiles_by_group(df, ["k"], {"p": (F.col("v"), probs)}, limit=2).first()["p"]
    assert [repr(x) for x in near[-2:]] == [repr(x) for x in far[-2:]]
    assert far[:2] == [-math.inf, -1e308] and math.isnan(far[-1]) and far[-2] == math.inf


def test_hot_groups_are_found_exactly(spark):
    df = spark.range(10_000).select(F.when(F.col("id") < 4_000, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"))
    assert [r["k"] for r in hot_groups(df, ["k"], 1_000).collect()] == [-1]
    assert hot_groups(df, ["k"], 4_000) is None
    assert hot_groups(df, ["k"], 1_000, max_rows=900) is None


def test_result_does_not_depend_on_partitioning(spark):
    rows = skewed_rows(9)
    results = []
    for n in (1, 8):
        df = spark.createDataFrame(rows, "k string, m int, v double").repartition(n)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        found = percentiles_by_group(df, ["k", "m"], {"p": (F.col("v"), PROBS)}, limit=200)
        results.append(sorted((str(r["k"]), r["m"], r["p"]) for r in found.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_crowded_bands_are_cut_finer(spark):
    """Thousands of distinct values so close together that the first bands cannot part them."""
    rng = random.Random(4)
    close = [20_000 + rng.random() * 1e-3 for _ in range(3_000)] + [20_000 + rng.random() * 1e-9 for _ in range(3_000)]
    rows = [("close", v) for v in close] + [("spread", rng.uniform(-9, 9)) for _ in range(1_000)] + [("same", 7.0)] * 500
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["p"] for r in percentiles_by_group(df, ["k"], {"p": (F.col("v"), PROBS)}, limit=50).collect()}
    for key in ("close", "spread", "same"):
        assert got[key] == pytest.approx(list(np.quantile([v for k, v in rows if k == key], PROBS)), rel=1e-14, abs=1e-14)
