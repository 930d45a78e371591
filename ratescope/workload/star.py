"""Price data derived from the star-schema tables, in the shapes the engine reads.

Each line item becomes one staged rate line: supplier nation = hospital, part = item and code,
customer = payer and plan. The rates table is written once per session and input folder, as the
engine's own build does, and all statistics read it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.config import PipelineConfig
from ratescope.functions import code_label, joined_labels
from ratescope.plans import silver
from ratescope.schemas import PAYER_RULES, STAGED_RATE_COLUMNS
from ratescope.sinks.scratch import write_stage

# Rates here are thousands of dollars, so the placeholder threshold is raised to have some.
CONFIG = PipelineConfig(min_plausible_rate=5000, procedure_scope="all")
FEATURED = replace(CONFIG, procedure_scope="featured")

# priority, category, pattern, note
RULES = (
    (1, "other_government", "furniture (3|7)$", "wins over the later furniture rule"),
    (2, "exchange", "building", None),
    (2, "exchange", "furniture", None),
    (3, "medicare_advantage", "auto|machinery 1", None),
    (4, "medicaid", "machinery", None),
)

# code_type, code, procedure_label, description
PROCEDURES = (
    ("CPT", "SMALL", "KNEE", "small parts"),
    ("hcpcs", "SMALL", "KNEE", "small parts"),
    ("CPT", "LARGE", "HIP", "large parts"),
    ("MS-DRG", "LARGE", "HIP_DRG", "large parts"),
    ("MS-DRG", "PROMO", None, "no label"),
)

# What is read of a line item and of the rows beside it.
LINE_COLUMNS = (
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "p_name", "p_brand", "p_type", "p_size", "n_name", "c_custkey", "c_mktsegment", "c_nationkey",
)

_written: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    """Write a derived table the first time it is asked for in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        _written[key] = write_stage(build(), label, drop_shuffles=True)
    return _written[key]


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, PAYER_RULES)


def procedures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROCEDURES, "code_type string, code string, procedure_label string, description string")


def code_type(part_size: Column) -> Column:
    return (
        F.when(part_size % 7 == 0, F.lit("CDM"))
        .when(part_size % 5 == 0, F.lit("MS-DRG"))
        .when(part_size % 2 == 0, F.lit("cpt"))
        .otherwise(F.lit("HCPCS"))
    )


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's customer, part, supplier and nation.

    Orders are joined with their customers and cut to what is read of them before they meet the lines, and the lines take
    the columns of the parts last, so that they are shuffled narrow.
    """
    paying = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "c_custkey", "c_mktsegment", "c_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(paying, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(*LINE_COLUMNS)
    )


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined lines as a table, for the price files that are written of them."""
    return once(spark, sf_dir, "lines", lambda: joined_lines(spark, sf_dir))


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a canonical staged rate row."""
    quantity, line = F.col("l_quantity"), F.col("l_linenumber")
    kind = F.upper(code_type(F.col("p_size")))
    own = code_label(kind, F.col("p_type"))
    labels = F.array(own, code_label(F.lit("cdm"), F.col("p_brand")), own)
    return joined_lines(spark, sf_dir).select(
        F.col("n_name").alias("source_key"),
        F.col("p_name").alias("item_description"),
        joined_labels(labels).alias("item_codes"),
        F.when(line > 5, F.lit("52")).alias("modifiers"),
        F.col("p_type").alias("code"),
        kind.alias("code_type"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM"), F.lit("KNEE"))
        .when(F.col("p_type") == "LARGE", F.lit("HIP"))
        .alias("procedure_label"),
        F.concat(F.lit(" "), F.col("l_returnflag"), F.lit(" ")).alias("setting"),
        F.when(line == 7, F.lit("  ")).otherwise(F.col("l_linestatus")).alias("billing_class"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("payer_name"),
        F.when(F.col("c_custkey") % 7 < 6, F.concat(F.lit("plan "), (F.col("c_custkey") % 7).cast("string"))).alias(
            "plan_name"
        ),
        F.when(quantity >= 5, F.col("l_extendedprice")).alias("negotiated_dollar"),
        F.when((quantity >= 3) & (quantity < 5), F.col("l_discount")).alias("negotiated_percentage"),
        F.when(quantity == 2, F.lit("per contract")).alias("negotiated_algorithm"),
        F.lit(None).cast("double").alias("estimated_amount"),
        F.when(line % 3 == 0, F.lit("case rate")).otherwise(F.lit("fee schedule")).alias("methodology"),
        F.col("l_extendedprice").alias("gross_charge"),
        F.col("l_discount").alias("min_charge"),
        F.col("l_tax").alias("max_charge"),
        F.concat(F.col("n_name"), F.lit(".csv")).alias("_source_file"),
        F.lit("run-1").alias("_run_id"),
    ).select(*STAGED_RATE_COLUMNS)


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hospital per nation; every third one has an assumed billing class."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("source_key"),
        F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("hospital_ccn"),
        F.concat(F.lit("Hospital of "), F.col("n_name")).alias("hospital_name"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("Facility")).otherwise(F.lit(" ")).alias("assumed_billing_class"),
    )


def header_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name/value header rows per nation with three spellings of the date."""
    day = (F.col("n_nationkey") % 9 + 1).cast("string")
    date = (
        F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("2025-10-0"), day))
        .when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit(" 1/"), day, F.lit("/2026")))
        .otherwise(F.lit("soon"))
    )
    pairs = F.array(
        F.struct(F.lit(" Last_Updated_On").alias("header_name"), date.alias("header_value")),
        F.struct(F.lit("hospital_name").alias("header_name"), F.col("n_name").alias("header_value")),
        F.struct(F.lit("license_number").alias("header_name"), F.lit("none").alias("header_value")),
    )
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("source_key"), F.inline(pairs))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negotiated-rates table of all line items."""
    def build() -> DataFrame:
        return silver.negotiated_rates(
            [staged_lines(spark, sf_dir)],
            crosswalk(spark, sf_dir),
            silver.price_file_headers(header_rows(spark, sf_dir)),
            rules(spark),
            CONFIG,
        )

    return once(spark, sf_dir, "rates", build)


def outcome_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as outcome measures: one measure row per event, user 0..149 modulo nations as facility."""
    month = F.date_format("ts", "MM/dd/yyyy")
    return table(spark, sf_dir, "events").select(
        F.lpad((F.col("user_id") % 30).cast("string"), 6, "0").alias("facility_id"),
        F.when(F.col("event_type") == "view", F.lit("readm_30_hip_knee"))
        .when(F.col("event_type") == "click", F.lit("COMP_HIP_KNEE"))
        .when(F.col("event_type") == "error", F.lit("READM_30_AMI"))
        .otherwise(F.lit("MORT_30"))
        .alias("measure_id"),
        F.when(F.col("event_id") % 11 == 0, F.lit("Not Available"))
        .otherwise(F.concat(F.lit(" "), (F.col("event_id") % 997).cast("string"), F.lit(" ")))
        .alias("score"),
        (F.col("event_id") % 50).cast("string").alias("lower_estimate"),
        (F.col("event_id") % 60).cast("string").alias("Higher_Estimate"),
        F.get_json_object("props", "$.k").alias("denominator"),
        F.col("event_type").alias("compared_to_national"),
        month.alias("end_date"),
    )


def general_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as listed facilities; some columns missing, some in another case."""
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("facility_id"),
            F.col("s_name").alias("facility_name"),
            F.when(F.col("n_regionkey") == 1, F.lit("TN")).otherwise(F.lit("KY")).alias("state"),
            F.col("n_name").alias("CountyParish"),
            F.when(F.col("s_acctbal") < 0, F.lit("Critical Access")).otherwise(F.lit("Acute Care")).alias("hospital_type"),
        )
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outcome_rows(spark, sf_dir)
    return silver.cms_outcomes(rows, rows)


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ratescope.plans import gold

    return gold.hospital_dimension(
        crosswalk(spark, sf_dir),
        silver.cms_hospitals(general_information(spark, sf_dir)),
        outcomes(spark, sf_dir),
        silver.price_file_headers(header_rows(spark, sf_dir)),
    )
