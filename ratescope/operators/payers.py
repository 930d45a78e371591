"""Payer categories by ordered regular-expression rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratescope.config import DEFAULT_PAYER_CATEGORY, PipelineConfig
from ratescope.functions import match_text
from ratescope.operators.lookups import broadcast_if_small
from ratescope.sinks.scratch import write_stage

#: Rules compiled into one CASE expression; longer lists become several, tried one after another.
_RULES_PER_CASE = 200
_NO_RULE = "struct<category:string,pattern:string>"


def _order(rule) -> tuple:
    """Lowest priority first, a missing one before all, then the pattern's text."""
    return rule["priority"] is not None, rule["priority"] or 0, rule["pattern"], rule["category"] or ""


def first_matching_rule(text: Column, rules: list) -> Column:
    """struct(category, pattern) of the first rule that matches. A rule without pattern never does."""
    usable = sorted((r for r in rules if r["pattern"] is not None), key=_order)
    cases = []
    for start in range(0, len(usable), _RULES_PER_CASE):
        case = F
        for r in usable[start:start + _RULES_PER_CASE]:
            hit = F.struct(F.lit(r["category"]).alias("category"), F.lit(r["pattern"]).alias("pattern"))
            case = case.when(text.rlike(r["pattern"]), hit)
        cases.append(case)
    return F.coalesce(*cases) if cases else F.lit(None).cast(_NO_RULE)


def with_payer_category(
    df: DataFrame, rules: DataFrame, cfg: PipelineConfig, payer: str = "payer_name", plan: str = "plan_name",
    names: DataFrame | None = None,
) -> DataFrame:
    """Add the category columns to any DataFrame with payer and plan names.

    The category depends on the two names only, which are few next to the rates. Distinct names are written and
    counted; up to ``max_broadcast_rows`` of them are matched once each and broadcast back, so no regular expression
    runs per row and no row is shuffled. More names than that are matched row by row in one CASE expression, unless
    the rules are more than ``max_inline_rows``: then they are matched once as well and joined back null-safely.
    ``names`` holds at least the names of ``df`` where those are cheaper to read than from ``df`` itself. Rule tables
    are written by hand, so the driver can hold one.
    """
    rows = rules.select("priority", "pattern", "category").collect()
    source = df if names is None else names
    named = write_stage(source.select(F.col(payer).alias("_payer"), F.col(plan).alias("_plan")).distinct(), "payer-names")
    if named.count() > cfg.max_broadcast_rows and len(rows) <= cfg.max_inline_rows:
        return category_of_each_row(df, rows, payer, plan)
    # The text is its own projection, so it is made once and not in every branch of the CASE.
    text = named.withColumn("_text", match_text(F.col("_payer"), F.col("_plan")))
    matched = text.select("_payer", "_plan", first_matching_rule(F.col("_text"), rows).alias("_rule"))
    found = broadcast_if_small(write_stage(matched.where("_rule is not null"), "matched-names"), cfg.max_broadcast_rows)
    joined = df.join(found, df[payer].eqNullSafe(found["_payer"]) & df[plan].eqNullSafe(found["_plan"]), "left")
    return _named_category(joined, [df[c] for c in df.columns])


def category_of_each_row(df: DataFrame, rules: list, payer: str = "payer_name", plan: str = "plan_name") -> DataFrame:
    """The same with the rules tried on every row; for rows that are distinct names already."""
    text = df.withColumn("_text", match_text(F.col(payer), F.col(plan)))
    return _named_category(text.withColumn("_rule", first_matching_rule(F.col("_text"), rules)), [F.col(c) for c in df.columns])


def _named_category(df: DataFrame, columns: list[Column]) -> DataFrame:
    return df.select(
        *columns,
        F.coalesce(F.col("_rule.category"), F.lit(DEFAULT_PAYER_CATEGORY)).alias("payer_category"),
        F.col("_rule.category").isNull().alias("payer_category_is_default"),
        F.col("_rule.pattern").alias("matched_pattern"),
    )


def payer_plan_names(staged: DataFrame) -> DataFrame:
    """Distinct trimmed payer and plan names of staged rates."""
    return staged.select(F.trim("payer_name").alias("payer_name"), F.trim("plan_name").alias("plan_name")).distinct()
