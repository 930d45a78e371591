from datetime import date

import pytest
from pyspark.sql import functions as F

from ratescope import functions as fn
from ratescope.config import PipelineConfig
from ratescope.operators.latest import latest_per_key
from ratescope.operators.payers import with_payer_category
from ratescope.sources.pages import default_payer_rules


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_numbers(spark):
    texts = ["", "  ", "12,5", "0.01", "-5", " 1e3 ", "N/A", None]
    assert values(spark, texts, fn.number_or_null) == [None, None, None, 0.01, -5.0, 1000.0, None, None]
    assert values(spark, texts, fn.text_or_null)[:3] == [None, None, "12,5"]


def test_dates(spark):
    texts = ["2025-10-01", "1/1/2026", "01/01/2026", "soon", None, "2025-10-01 10:11:12"]
    expected = [date(2025, 10, 1), date(2026, 1, 1), date(2026, 1, 1), None, None, date(2025, 10, 1)]
    assert values(spark, texts, fn.parse_file_date) == expected


def test_names(spark):
    same = lambda c: fn.names_overlap(c, F.lit("Saint Thomas Hospital"))
    assert values(spark, ["THOMAS clinic", "General Hospital", "St. T."], same) == [True, False, False]


def test_rate_classes(spark):
    df = spark.createDataFrame([(5.0, 1.0, "x"), (None, 1.0, "x"), (None, None, "x"), (None, None, None)], "d double, p double, a string")
    kind = fn.rate_type(F.col("d"), F.col("p"), F.col("a"))
    assert [r[0] for r in df.select(kind).collect()] == ["dollar", "percentage", "algorithm", "none"]
    flagged = spark.createDataFrame([(-5.0,), (0.99,), (1.0,), (None,)], "d double").select(fn.is_placeholder(F.col("d"), 1))
    assert [r[0] for r in flagged.collect()] == [True, True, False, False]


def test_billing_class(spark):
    df = spark.createDataFrame([(" Facility ", "x"), (" ", " FACILITY"), (None, " "), ("", None)], "a string, b string")
    got = df.select(
        fn.billing_class(F.col("a"), F.col("b")), fn.billing_class_is_assumed(F.col("a"), F.col("b"))
    ).collect()
    # Case is folded before blanks are trimmed away.
    assert [tuple(r) for r in got] == [("facility", False), ("facility", True), (None, False), (None, False)]


def test_optional_column(spark):
    df = spark.createDataFrame([("x",)], "`City Town` string")
    row = df.select(
        fn.optional_column(df, "city town").alias("a"), fn.optional_column(df, "zip", "double").alias("b")
    ).first()
    assert (row["a"], row["b"]) == ("x", None)


@pytest.mark.parametrize("inline", [1_000, 1])
def test_payer_categories(spark, inline):
    rows = [
        ("BCBST / Network E", None, "exchange"),
        ("Aetna-Medicare Adv.", "x", "medicare_advantage"),
        (None, "TriWest", "other_government"),
        ("Oscar Medicaid", "p", "exchange"),
        ("Cigna", "PPO", None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "payer_name string, plan_name string, expected string")
    got = with_payer_category(df, default_payer_rules(spark), PipelineConfig(max_inline_rows=inline))
    for r in got.collect():
        assert r["payer_category"] == (r["expected"] or "commercial")
        assert r["payer_category_is_default"] == (r["expected"] is None)
    assert got.count() == len(rows)


def test_few_names_are_matched_once_each(spark):
    """Up to the bound no regular expression is left in the plan of the rows; beyond it, rows are matched without a join."""
    df = spark.range(3_000).selectExpr(
        "id", "case when id % 3 = 0 then 'Acme' when id % 3 = 1 then 'Blue' end as payer_name", "if(id % 2 = 0, 'Gold', null) as plan_name"
    )
    rules = spark.createDataFrame([(1, "acme", "a"), (2, "gold", "g")], "priority int, pattern string, category string")
    few = with_payer_category(df, rules, PipelineConfig())
    many = with_payer_category(df, rules, PipelineConfig(max_broadcast_rows=5))
    joined = with_payer_category(df, rules, PipelineConfig(max_broadcast_rows=5, max_inline_rows=1))
    elsewhere = with_payer_category(df, rules, PipelineConfig(), names=df.union(df.limit(3)))
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (few, many, joined)]
    assert ["RLIKE" in p for p in plans] == [False, True, False]
    assert ["Join" in p for p in plans] == [True, False, True]
    rows = sorted(map(tuple, few.collect()), key=lambda r: r[0])
    assert len(rows) == 3_000 and {r[3] for r in rows} == {"a", "g", "commercial"}
    for other in (many, joined, elsewhere):
        assert sorted(map(tuple, other.collect()), key=lambda r: r[0]) == rows


def test_latest_keeps_one_row_and_puts_nulls_last(spark):
    rows = [("a", None, "9", "x"), ("a", "01/01/2024", "1", "y"), ("b", None, None, "z"), ("a", "01/01/2024", "2", "w")]
    df = spark.createDataFrame(rows, "k string, e string, s string, v string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["e", "s"]).collect())
    assert got == [("a", "01/01/2024", "2", "w"), ("b", None, None, "z")]


@pytest.mark.parametrize("inline", [1_000, 0])
def test_rules_with_missing_cells(spark, inline):
    rules = spark.createDataFrame(
        [(2, "acme", "second"), (None, "acme gold", "first"), (1, None, "never"), (3, "acme", "third")],
        "priority int, pattern string, category string",
    )
    df = spark.createDataFrame([("Acme", "Gold"), ("Acme", None), (None, None)], "payer_name string, plan_name string")
    got = with_payer_category(df, rules, PipelineConfig(max_inline_rows=inline))
    found = {(r["payer_name"], r["plan_name"]): (r["payer_category"], r["matched_pattern"]) for r in got.collect()}
    assert found == {("Acme", "Gold"): ("first", "acme gold"), ("Acme", None): ("second", "acme"), (None, None): ("commercial", None)}
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("inline", [1_000, 0])
def test_mentioned_codes_stand_in_quotes(spark, inline):
    from ratescope.operators.lookups import mentioning_codes

    texts = ['{"code":"A1"}', '{"code":"A12"}', 'A1', '"A1', '"x"A1"y"', '{"c":"B"2"}', '""', None, '{"code":"A1"}']
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    codes = spark.createDataFrame([("A1",), ('B"2',), ("",), (None,)], "code string")
    got = mentioning_codes(items, "t", codes, PipelineConfig(max_inline_rows=inline))
    assert sorted(r["i"] for r in got.collect()) == [i for i, t in enumerate(texts) if t and any(f'"{c}"' in t for c in ("A1", 'B"2', ""))]
