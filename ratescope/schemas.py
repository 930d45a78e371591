"""Schemas shared by sources, plans and sinks."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The canonical staged rate row, in order. Every staging plan returns exactly these columns.
STAGED_RATE_COLUMNS = (
    "source_key", "item_description", "item_codes", "modifiers", "code", "code_type", "procedure_label",
    "setting", "billing_class", "payer_name", "plan_name", "negotiated_dollar", "negotiated_percentage",
    "negotiated_algorithm", "estimated_amount", "methodology", "gross_charge", "min_charge", "max_charge",
    "_source_file", "_run_id",
)

LINEAGE_COLUMNS = ("_source_file", "_run_id", "_ingested_at")

CROSSWALK = strings("source_key", "hospital_ccn", "hospital_name", "assumed_billing_class")
PROCEDURE_CODES = strings("code_type", "code", "procedure_label", "description")
PAYER_RULES = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("note", T.StringType()),
])
HEADER = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("header_name", T.StringType()),
    T.StructField("header_value", T.StringType()),
])

# Nested price item. Every scalar is text, so one odd value cannot void a whole item.
_PAYER = strings(
    "payer_name", "plan_name", "standard_charge_dollar", "standard_charge_percentage",
    "standard_charge_algorithm", "estimated_amount", "methodology",
)
_CHARGE = strings("setting", "billing_class", "gross_charge", "discounted_cash", "minimum", "maximum").add(
    "payers_information", T.ArrayType(_PAYER)
)
PRICE_ITEM = (
    strings("description")
    .add("code_information", T.ArrayType(strings("code", "type")))
    .add("standard_charges", T.ArrayType(_CHARGE))
)

# Load log: one row per run, dataset and page event. New columns only ever go at the end.
MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("dataset_key", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("row_count", T.IntegerType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType()),
    T.StructField("landing_path", T.StringType()),
    T.StructField("event_ts", T.TimestampType(), False),
    T.StructField("file_bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("etag", T.StringType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("note", T.StringType()),
])
MANIFEST_STATUSES = ("started", "succeeded", "failed", "skipped")
PRICE_FILE_SOURCE = "hospital_price_file"
