"""Analyst diagnostics over the negotiated-rates and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratescope.config import PipelineConfig
from ratescope.operators.lookups import null_safe
from ratescope.operators.percentiles import percentiles_by_group
from ratescope.sinks.scratch import write_stage

LINE_KEYS = ("source_key", "code_type", "code", "setting", "billing_class", "payer_name", "plan_name", "item_description")
ITEM_KEYS = (*LINE_KEYS, "item_codes", "modifiers")
SAMPLE_ORDER = ("code", "payer_name", "plan_name", "setting", "item_description")


def _differs(column: str) -> Column:
    """More than one distinct value in the group. One shuffle, unlike a distinct count."""
    return F.coalesce(F.min(column) < F.max(column), F.lit(False))


def duplicate_groups(df: DataFrame, keys: Sequence[str], *extra: Column) -> DataFrame:
    """Groups of equal keys (NULL equals NULL) with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *extra).filter(F.col("n_rows") > 1)


def duplicates_by_source(rates: DataFrame) -> DataFrame:
    groups = duplicate_groups(rates, LINE_KEYS, _differs("negotiated_dollar").alias("d_dollar"))
    return groups.groupBy("source_key").agg(
        F.count("*").alias("duplicate_groups"),
        F.sum(F.when(F.col("d_dollar"), 0).otherwise(1)).alias("identical_amount_groups"),
    )


def duplicate_differences(rates: DataFrame) -> DataFrame:
    """What differs inside duplicate groups, per source."""
    measured = ("negotiated_dollar", "methodology", "gross_charge", "min_charge", "max_charge", "rate_type")
    groups = duplicate_groups(rates, ITEM_KEYS, *[_differs(c).alias(f"d_{c}") for c in measured])

    def count_if(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    charges = F.col("d_gross_charge") | F.col("d_min_charge") | F.col("d_max_charge")
    return groups.groupBy("source_key").agg(
        F.count("*").alias("dup_groups"),
        count_if(F.col("d_negotiated_dollar")).alias("different_dollar_amounts"),
        count_if(F.col("d_methodology")).alias("different_methodology"),
        count_if(charges).alias("different_charges"),
        count_if(F.col("d_rate_type")).alias("mixed_rate_types"),
    ).orderBy("source_key")


def duplicate_sample(rates: DataFrame, keys: Sequence[str] = LINE_KEYS, groups_per_source: int = 3) -> DataFrame:
    """Rows of the first duplicate groups of each source.

    Groups are numbered on the counted groups, not on the rows, and only the first few per source leave
    each task. The chosen groups are written, so their size decides how they are joined back.
    """
    groups = duplicate_groups(rates, keys).select(*keys)
    numbered = groups.withColumn(
        "grp", F.dense_rank().over(Window.partitionBy("source_key").orderBy(*SAMPLE_ORDER))
    )
    chosen = write_stage(numbered.filter(F.col("grp") <= groups_per_source), "sampled-groups")
    rows = rates.join(chosen, null_safe(rates, chosen, keys)).select(*[rates[c] for c in rates.columns], "grp")
    return rows.select(
        "source_key", "grp", "code", "setting", "billing_class", "payer_name", "plan_name", "rate_type",
        "negotiated_dollar", "negotiated_percentage", "methodology", "gross_charge", "min_charge", "max_charge",
    ).orderBy("source_key", "grp", "negotiated_dollar")


def usable_rates(rates: DataFrame) -> DataFrame:
    return rates.filter((F.col("rate_type") == "dollar") & ~F.col("is_placeholder_rate"))


def rate_spread(rates: DataFrame, codes: Sequence[str], cfg: PipelineConfig) -> DataFrame:
    """Line-level min, median and max by source, code, setting and billing class."""
    keys = ["source_key", "code", "setting", "billing_class"]
    kept = usable_rates(rates).filter(F.col("code").isin(list(codes))).select(*keys, "negotiated_dollar")
    spread = percentiles_by_group(
        kept,
        keys,
        {"_middle": (F.col("negotiated_dollar"), [0.5])},
        [
            F.count("*").alias("n_rates"),
            F.min("negotiated_dollar").alias("min_rate"),
            F.max("negotiated_dollar").alias("max_rate"),
        ],
        limit=cfg.hot_group_rows,
        max_rows=rates.count(),
    )
    return spread.select(
        *keys, "n_rates", "min_rate", F.col("_middle")[0].alias("median_rate"), "max_rate"
    ).orderBy("code", "source_key", "setting", "billing_class")


def counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def rate_type_counts(rates: DataFrame, codes: Sequence[str], source_key: str | None = None) -> DataFrame:
    keys = ["source_key", "code", "setting", "billing_class", "rate_type"]
    kept = rates.filter(F.col("code").isin(list(codes)))
    if source_key is not None:
        kept, keys = kept.filter(F.col("source_key") == source_key), keys[1:]
    return counts(kept, keys, "n_rates").orderBy(*keys)


def category_coverage(payer_categories: DataFrame) -> DataFrame:
    """How many payer/plan names each category holds, and how many by default."""
    keys = ["payer_category", "payer_category_is_default"]
    return counts(payer_categories, keys, "n_payer_plans").orderBy(F.col("n_payer_plans").desc())


def item_breakdown(rates: DataFrame, source_key: str, code: str) -> DataFrame:
    kept = rates.filter(
        (F.col("source_key") == source_key) & (F.col("code") == code) & (F.col("rate_type") == "dollar")
    )
    return kept.groupBy("item_description", "item_codes", "setting").agg(
        F.count("*").alias("n"),
        F.min("negotiated_dollar").alias("min_rate"),
        F.max("negotiated_dollar").alias("max_rate"),
    )


def top_payer_plans(rates: DataFrame, n: int = 100) -> DataFrame:
    """The most frequent payer/plan names; names break ties."""
    named = counts(rates.filter(F.col("rate_type") == "dollar"), ["payer_name", "plan_name"], "n")
    return named.orderBy(F.col("n").desc(), "payer_name", "plan_name").limit(n)


def lowest_payer_rates(rates: DataFrame, codes: Sequence[str], billing_class: str, category: str, n: int = 40) -> DataFrame:
    """Payer/plans with the lowest rates of one category."""
    kept = usable_rates(rates).filter(
        (F.col("payer_category") == category)
        & F.col("code").isin(list(codes))
        & (F.col("billing_class") == billing_class)
    )
    named = kept.groupBy("hospital_name", "payer_name", "plan_name").agg(
        F.min("negotiated_dollar").alias("min_rate"), F.max("negotiated_dollar").alias("max_rate")
    )
    return named.orderBy("min_rate", "hospital_name", "payer_name", "plan_name").limit(n)


def drill_down(rates: DataFrame, source_key: str, code: str, payer_name: str, plan_like: str) -> DataFrame:
    """Dollar lines of one payer and a plan-name pattern."""
    kept = rates.filter(
        (F.col("source_key") == source_key)
        & (F.col("code") == code)
        & (F.col("rate_type") == "dollar")
        & (F.col("payer_name") == payer_name)
        & F.col("plan_name").like(plan_like)
    )
    return kept.select(
        "item_description", "item_codes", "modifiers", "setting", "negotiated_dollar", "methodology"
    ).orderBy("negotiated_dollar")


def look_up(gold: DataFrame, order_by: Sequence[str], **equals) -> DataFrame:
    """Rows of a gold table by column values (a value, or a list of them), ordered."""
    for column, value in equals.items():
        gold = gold.filter(F.col(column).isin(list(value)) if isinstance(value, (list, tuple)) else F.col(column) == value)
    return gold.orderBy(*order_by)


def measure_ids(measures: DataFrame, pattern: str = "%HIP%") -> DataFrame:
    return measures.filter(F.upper("measure_id").like(pattern)).select("measure_id").distinct()


def reporting_hospitals(outcomes: DataFrame, hospitals: DataFrame, state: str) -> DataFrame:
    """How many hospitals of a state report a readmission rate."""
    reported = outcomes.filter("readmission_reported").select("hospital_ccn")
    local = hospitals.filter(F.col("state") == state).select("hospital_ccn")
    return reported.join(local, "hospital_ccn").agg(F.count("*").alias("hospitals_with_readmission_rate"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of row counts, one row per table."""
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n") for t, df in tables.items()]
    result = counted[0]
    for c in counted[1:]:
        result = result.unionByName(c)
    return result
