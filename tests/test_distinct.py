"""Distinct rows in bounded tasks: the rows of Spark's distinct, whatever repeats."""

import math
import time

import pytest
from pyspark.sql import functions as F

from ratescope.operators.distinct import distinct_rows
from ratescope.sinks import scratch
from ratescope.sinks.scratch import write_portions, write_stage
from ratescope.workload import star


def _table(spark):
    """Rows that repeat four times, rows that do not, one that makes up a third, zeros of both signs, NaN and nulls."""
    some = spark.range(1200).select((F.col("id") % 300).alias("a"), F.when(F.col("id") % 3 == 0, "x").alias("b"), F.lit(0.5).alias("c"))
    single = spark.range(700).select((F.col("id") + 1000).alias("a"), F.lit("y").alias("b"), F.lit(None).cast("double").alias("c"))
    hot = spark.range(900).select(F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(1.0).alias("c"))
    odd = spark.createDataFrame([(1, "z", v) for v in (0.0, -0.0, math.nan, math.nan, None, None)], "a bigint, b string, c double")
    return write_stage(some.unionByName(single).unionByName(hot).unionByName(odd), "test-distinct")


def test_same_rows_as_distinct(spark):
    df = _table(spark)
    told = lambda rows: sorted(map(repr, rows.collect()))
    assert told(distinct_rows(df, 100)) == told(distinct_rows(df)) == told(df.distinct())


def _shuffled(spark) -> set[str]:
    """Shuffle files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.mark.parametrize("rows_at_once", [10, 1_000, 100_000])
def test_same_rows_in_portions(spark, rows_at_once):
    df = _table(spark)
    told = lambda rows: sorted(map(repr, rows.collect()))
    assert told(distinct_rows(df, 100, rows_at_once)) == told(df.distinct())


def test_portions_leave_no_shuffle_files(spark):
    """A portion's shuffle is gone once it is stored; what a large table was made of, too."""
    df = _table(spark)
    counts = df.groupBy("a").count().repartition(3)
    before = _shuffled(spark)
    write_portions([df.where(F.col("a") % 2 == k).repartition(5, "a").distinct() for k in range(2)], "test-portions")
    stored = write_stage(counts, "test-counts", drop_shuffles=True)
    for _ in range(50):
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(scratch._CLEANUP, None) is None
    assert stored.count() == 1_001
    df.groupBy("a").count().write.format("noop").mode("overwrite").save()
    assert _shuffled(spark) - before


def test_tasks_hold_few_rows(spark):
    """Whole rows are compared behind the one shuffle, in tasks of bounded size; only the crowding row is combined before."""
    rows = distinct_rows(_table(spark), 100)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.count("ENSURE_REQUIREMENTS") == 1
    assert "hashpartitioning(a" in plan and ", 29), REPARTITION_BY_NUM" in plan


def test_lines_are_joined_narrow(spark, tmp_path):
    """A line comes once per match, without a match not at all, with no more columns than are read of it."""
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string",
                     [(o, p, s, n, 1.0, 2.0, 0.1, 0.2, "R", "O") for n, (o, p, s) in enumerate([(1, 1, 1), (2, 1, 1), (None, 1, 1), (1, None, 1), (1, 1, 9)])]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (1, 2), (2, None), (None, 1)]),
        "customer": ("c_custkey long, c_mktsegment string, c_nationkey int", [(1, "A", 0), (2, None, None)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int", [(1, "n", "b", "t", 3), (1, "m", "b", "t", 3)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 0)]),
        "nation": ("n_nationkey int, n_name string", [(0, "N")]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = star.joined_lines(spark, str(tmp_path))
    assert lines.columns == list(star.LINE_COLUMNS)
    assert sorted((r["l_linenumber"], r["c_custkey"], r["p_name"]) for r in lines.collect()) == [(0, 1, "m"), (0, 1, "n"), (0, 2, "m"), (0, 2, "n")]
