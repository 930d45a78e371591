"""Registered queries over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratescope.operators.percentiles import percentiles_by_group
from ratescope.plans import diagnostics, gold, reports, silver
from ratescope.workload import star
from ratescope.workload.star import CONFIG, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so two engines agree on the last digits."""
    return df.select(*[
        F.round(c, places).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else F.col(c)
        for c in df.columns
    ])


# ------------------------------------------------------------------------------ models and reports
def by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.price_by_payer_category(star.rates(spark, sf_dir), CONFIG)


def variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.price_variation(star.rates(spark, sf_dir), star.hospitals(spark, sf_dir), CONFIG)


def stored_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.once(spark, sf_dir, "by-category", lambda: by_category(spark, sf_dir))


def stored_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.once(spark, sf_dir, "variation", lambda: variation(spark, sf_dir))


@query
def rates_by_payer_category(spark, sf_dir):
    return rounded(by_category(spark, sf_dir))


@query
def rates_by_payer_category_hot_groups(spark, sf_dir):
    """The same statistics with every larger group ranked across tasks, at both levels."""
    cfg = replace(CONFIG, hot_group_rows=20)
    return rounded(gold.price_by_payer_category(star.rates(spark, sf_dir), cfg))


@query
def price_variation(spark, sf_dir):
    return rounded(variation(spark, sf_dir))


@query
def variation_across_hospitals(spark, sf_dir):
    return rounded(gold.variation_across_hospitals(stored_variation(spark, sf_dir), CONFIG))


@query
def hospital_comparison(spark, sf_dir):
    return rounded(gold.hospital_comparison(stored_by_category(spark, sf_dir), CONFIG))


@query
def payer_category_gap(spark, sf_dir):
    return rounded(gold.payer_category_gap(stored_by_category(spark, sf_dir)))


@query
def price_vs_readmission(spark, sf_dir):
    return rounded(gold.price_vs_readmission(stored_variation(spark, sf_dir), star.outcomes(spark, sf_dir)))


@query
def hospital_dimension(spark, sf_dir):
    return star.hospitals(spark, sf_dir)


@query
def outcome_latest(spark, sf_dir):
    return star.outcomes(spark, sf_dir)


@query
def cms_hospitals(spark, sf_dir):
    return silver.cms_hospitals(star.general_information(spark, sf_dir))


@query
def price_file_headers(spark, sf_dir):
    return silver.price_file_headers(star.header_rows(spark, sf_dir))


@query
def payer_categories(spark, sf_dir):
    return silver.payer_categories(star.staged_lines(spark, sf_dir), star.rules(spark), CONFIG)


@query
def negotiated_rates(spark, sf_dir):
    return rounded(star.rates(spark, sf_dir)).drop("estimated_amount", "_source_file", "_run_id")


@query
def commercial_prices(spark, sf_dir):
    return rounded(reports.commercial_prices(
        stored_by_category(spark, sf_dir), ["SMALL", "LARGE"], 3, billing_class="f", setting="a"
    ))


@query
def price_by_category(spark, sf_dir):
    return rounded(reports.price_by_category(stored_by_category(spark, sf_dir), "SMALL", "f", "a"))


@query
def hospital_finder(spark, sf_dir):
    """Customers as facilities: two name fragments, one state."""
    facilities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Facility_ID"),
        F.col("c_name").alias("facility_name"),
        F.when(F.col("c_nationkey") < 13, F.lit("TN")).otherwise(F.lit("KY")).alias("state"),
        F.col("c_mktsegment").alias("hospital_type"),
    )
    found = reports.find_hospitals(facilities, ["CUSTOMER#0000000[12]", "77$"])
    return found


# ---------------------------------------------------------------------------- exact percentiles
@query
def exact_percentiles(spark, sf_dir):
    """Quartiles by Spark's aggregate, for groups of bounded size."""
    lines = table(spark, sf_dir, "lineitem")
    return _quartiles(lines, ["l_suppkey"], limit=10_000_000)


@query
def exact_percentiles_hot_groups(spark, sf_dir):
    """The same with three groups that each hold a third of the lines, ranked across tasks."""
    lines = table(spark, sf_dir, "lineitem")
    return _quartiles(lines, ["l_returnflag"], limit=1_000)


def _quartiles(lines: DataFrame, keys: list[str], limit: int) -> DataFrame:
    price, tax = F.col("l_extendedprice"), F.when(F.col("l_quantity") > 25, F.col("l_tax"))
    found = percentiles_by_group(
        lines, keys, {"price": (price, [0.25, 0.5, 0.75]), "tax": (tax, [0.5])},
        [F.count("*").alias("n")], limit=limit,
    )
    return rounded(found.select(
        *keys, "n", F.col("price")[0].alias("p25_price"), F.col("price")[1].alias("median_price"),
        F.col("price")[2].alias("p75_price"), F.col("tax")[0].alias("median_tax"),
    ))


# ----------------------------------------------------------------------------------- diagnostics
CODES = ("SMALL", "LARGE")


@query
def duplicates_by_source(spark, sf_dir):
    return diagnostics.duplicates_by_source(_coarse(spark, sf_dir))


@query
def duplicate_differences(spark, sf_dir):
    return diagnostics.duplicate_differences(_coarse(spark, sf_dir))


@query
def duplicate_sample(spark, sf_dir):
    return rounded(diagnostics.duplicate_sample(_coarse(spark, sf_dir)))


def _coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates with plans and items dropped, so that lines do repeat on the grain."""
    return star.rates(spark, sf_dir).withColumns({
        "plan_name": F.lit(None).cast("string"), "item_description": F.lit("any"), "item_codes": F.lit("any"),
    })


@query
def rate_spread(spark, sf_dir):
    return rounded(diagnostics.rate_spread(star.rates(spark, sf_dir), CODES, CONFIG))


@query
def rate_type_counts(spark, sf_dir):
    return diagnostics.rate_type_counts(star.rates(spark, sf_dir), CODES)


@query
def rate_type_counts_of_source(spark, sf_dir):
    return diagnostics.rate_type_counts(star.rates(spark, sf_dir), CODES, "NATION_3")


@query
def category_coverage(spark, sf_dir):
    names = silver.payer_categories(star.staged_lines(spark, sf_dir), star.rules(spark), CONFIG)
    return diagnostics.category_coverage(names)


@query
def item_breakdown(spark, sf_dir):
    return rounded(diagnostics.item_breakdown(star.rates(spark, sf_dir), "NATION_3", "SMALL"))


@query
def top_payer_plans(spark, sf_dir):
    return diagnostics.top_payer_plans(star.rates(spark, sf_dir), 100)


@query
def lowest_payer_rates(spark, sf_dir):
    return rounded(diagnostics.lowest_payer_rates(star.rates(spark, sf_dir), CODES, "f", "commercial", 40))


@query
def drill_down(spark, sf_dir):
    return rounded(diagnostics.drill_down(star.rates(spark, sf_dir), "NATION_3", "SMALL", "HOUSEHOLD 4", "plan%"))


@query
def gold_look_up(spark, sf_dir):
    across = gold.variation_across_hospitals(stored_variation(spark, sf_dir), CONFIG)
    return rounded(diagnostics.look_up(across, ["code", "setting"], code=CODES, billing_class="f"))


@query
def measure_ids(spark, sf_dir):
    return diagnostics.measure_ids(star.outcome_rows(spark, sf_dir))


@query
def reporting_hospitals(spark, sf_dir):
    return diagnostics.reporting_hospitals(
        star.outcomes(spark, sf_dir), silver.cms_hospitals(star.general_information(spark, sf_dir)), "TN"
    )


@query
def table_counts(spark, sf_dir):
    names = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region"]
    return diagnostics.table_counts({n: table(spark, sf_dir, n) for n in names})
