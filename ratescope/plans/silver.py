"""File headers, hospitals, outcomes and the negotiated-rates table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratescope.config import PipelineConfig
from ratescope.functions import (
    billing_class,
    billing_class_is_assumed,
    code_family,
    is_placeholder,
    number_or_null,
    optional_column,
    parse_file_date,
    rate_type,
)
from ratescope.operators.distinct import distinct_rows
from ratescope.operators.lookups import broadcast_if_small
from ratescope.operators.latest import latest_per_key
from ratescope.operators.payers import category_of_each_row, payer_plan_names, with_payer_category
from ratescope.operators.reshape import pivot_headers
from ratescope.sinks.scratch import write_stage


def tagged_union(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of header tables, each tagged with its source key."""
    tagged = [df.select(F.lit(k).alias("source_key"), "header_name", "header_value") for k, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def price_file_headers(headers: DataFrame) -> DataFrame:
    """One row per file: last-updated date, hospital name and version as the file states them."""
    wide = pivot_headers(headers, ["last_updated_on", "hospital_name", "version"])
    return wide.select(
        "source_key",
        F.col("last_updated_on").alias("last_updated_raw"),
        parse_file_date(F.col("last_updated_on")).alias("last_updated_on"),
        F.col("hospital_name").alias("hospital_name_in_file"),
        F.col("version").alias("file_version"),
    )


def payer_categories(staged: DataFrame, rules: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One row per payer/plan name with its category."""
    return category_of_each_row(payer_plan_names(staged), rules.select("priority", "pattern", "category").collect())


def cms_hospitals(general: DataFrame) -> DataFrame:
    """Hospital attributes; columns the publisher may drop become NULL."""
    return general.select(
        F.col("facility_id").alias("hospital_ccn"),
        F.col("facility_name").alias("hospital_name"),
        optional_column(general, "citytown").alias("city"),
        optional_column(general, "countyparish").alias("county"),
        F.col("state"),
        optional_column(general, "zip_code").alias("zip_code"),
        optional_column(general, "hospital_type").alias("hospital_type"),
        optional_column(general, "hospital_ownership").alias("hospital_ownership"),
    )


def latest_measure(
    measures: DataFrame, kind: str, columns: Mapping[str, str], date_order: bool = False
) -> DataFrame:
    """Latest hip/knee row per facility of one measure kind.

    ``columns`` maps output names to source columns. Latest means greatest ``end_date`` text, or the
    greatest parsed date with ``date_order``; the score text breaks ties.
    """
    measure = F.upper("measure_id")
    end = optional_column(measures, "end_date")
    rows = measures.filter(measure.like(f"%{kind}%") & measure.like("%HIP%KNEE%")).select(
        F.col("facility_id").alias("hospital_ccn"),
        (parse_file_date(end) if date_order else end).alias("_end"),
        F.col("score").alias("_score"),
        *[optional_column(measures, source).alias(name) for name, source in columns.items()],
    )
    return latest_per_key(rows, ["hospital_ccn"], ["_end", "_score"]).drop("_end")


def cms_outcomes(visits: DataFrame, complications: DataFrame, date_order: bool = False) -> DataFrame:
    """One row per hospital with a readmission row, next to its complication measure."""
    r = latest_measure(
        visits,
        "READM",
        {
            "lower": "lower_estimate", "upper": "higher_estimate", "denominator": "denominator",
            "vs": "compared_to_national", "footnote": "footnote", "start": "start_date", "end": "end_date",
        },
        date_order,
    )
    readmission = r.select(
        "hospital_ccn",
        number_or_null(F.col("_score")).alias("readmission_rate"),
        number_or_null(F.col("lower")).alias("readmission_lower"),
        number_or_null(F.col("upper")).alias("readmission_upper"),
        number_or_null(F.col("denominator")).alias("readmission_denominator"),
        F.col("vs").alias("readmission_vs_national"),
        F.col("footnote").alias("readmission_footnote"),
        F.col("start").alias("readmission_start_date"),
        F.col("end").alias("readmission_end_date"),
        number_or_null(F.col("_score")).isNotNull().alias("readmission_reported"),
    )
    complication = latest_measure(complications, "COMP", {"vs": "compared_to_national"}, date_order).select(
        "hospital_ccn",
        number_or_null(F.col("_score")).alias("complication_rate"),
        F.col("vs").alias("complication_vs_national"),
    )
    return readmission.join(complication, "hospital_ccn", "left")


def negotiated_rates(
    staged: Sequence[DataFrame],
    crosswalk: DataFrame,
    headers: DataFrame,
    rules: DataFrame,
    cfg: PipelineConfig,
    rows_at_once: int | None = None,
) -> DataFrame:
    """The silver rate table: exact repeats removed, hospital, file date and payer category added.

    The distinct is the only shuffle of the rates. They are written first, so that what stages them runs once. Categories
    belong to the names, which are read from the staged rates as two columns and matched once each; the hospital and header
    tables have one row per file. All are broadcast after a count. ``rows_at_once`` bounds what the distinct shuffles at once.
    """
    stated = write_stage(reduce(DataFrame.unionByName, staged), "staged-rates")
    rates = with_payer_category(distinct_rows(stated, rows_at_once=rows_at_once), rules, cfg, names=stated)
    hospital = crosswalk.select("source_key", "hospital_ccn", "hospital_name", "assumed_billing_class")
    dates = headers.select("source_key", F.col("last_updated_on").alias("file_last_updated_on"))
    joined = rates.join(broadcast_if_small(hospital, cfg.max_broadcast_rows), "source_key").join(
        broadcast_if_small(dates, cfg.max_broadcast_rows), "source_key", "left"
    )
    dollar = F.col("negotiated_dollar")
    in_file, assumed = F.col("billing_class"), F.col("assumed_billing_class")
    return joined.select(
        "source_key",
        "hospital_ccn",
        "hospital_name",
        "code_type",
        code_family(F.col("code_type")).alias("code_family"),
        "code",
        "procedure_label",
        F.col("procedure_label").isNotNull().alias("is_featured"),
        "item_description",
        "item_codes",
        "modifiers",
        F.lower(F.trim("setting")).alias("setting"),
        billing_class(in_file, assumed).alias("billing_class"),
        billing_class_is_assumed(in_file, assumed).alias("billing_class_assumed"),
        F.trim("payer_name").alias("payer_name"),
        F.trim("plan_name").alias("plan_name"),
        "payer_category",
        "payer_category_is_default",
        rate_type(dollar, F.col("negotiated_percentage"), F.col("negotiated_algorithm")).alias("rate_type"),
        "negotiated_dollar",
        "negotiated_percentage",
        "negotiated_algorithm",
        "estimated_amount",
        "methodology",
        "gross_charge",
        "min_charge",
        "max_charge",
        is_placeholder(dollar, cfg.min_plausible_rate).alias("is_placeholder_rate"),
        "file_last_updated_on",
        "_source_file",
        "_run_id",
    )
