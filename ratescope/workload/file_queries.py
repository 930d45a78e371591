"""Registered queries over written files, load logs, reshapes and quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratescope import functions as fn
from ratescope.config import PageSetSpec
from ratescope.operators import lookups, reshape
from ratescope.plans import build, gold, manifest, quality, silver, staging
from ratescope.plans.build import Schemas
from ratescope.schemas import CROSSWALK, PRICE_ITEM
from ratescope.sinks import tables
from ratescope.sinks.scratch import scratch_path, write_stage
from ratescope.sources.pages import read_pages, read_seed
from ratescope.sources.price_csv import N_LEADS, open_price_csv, price_csv_headers, read_price_csv
from ratescope.sources.price_json import open_price_json, price_json_headers, price_json_items
from ratescope.workload import files, star
from ratescope.workload.queries import query, rounded, stored_variation
from ratescope.workload.star import CONFIG, FEATURED, table

_FILE_COLUMNS = ("_source_file",)
#: Bytes of a range where a query is to read files in several even at the smallest size.
_SMALL_RANGES = 1 << 18
#: Rates shuffled at once where the files they were read from take disk as well.
_ROWS_AT_ONCE = 25_000_000


def _with_run(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("_run_id", F.lit("run-1"))


def _tall(spark: SparkSession, sf_dir: str, slots: int) -> DataFrame:
    return _with_run(read_price_csv(spark, files.tall_csv(spark, sf_dir, slots))[1])


# ---------------------------------------------------------------------------- price-file layouts
@query
def tall_csv_rates(spark, sf_dir):
    """Four code slots, billing class, quoted newlines; every file is read in ranges."""
    bronze = _tall(spark, sf_dir, 4)
    staged = staging.stage_tall_csv(bronze, star.procedures(spark), "tall", (1, 2, 3, 4), True, CONFIG)
    return rounded(staged.drop(*_FILE_COLUMNS))


@query
def tall_csv_featured_rates(spark, sf_dir):
    """Two code slots, no billing class, featured scope."""
    bronze = _tall(spark, sf_dir, 2)
    staged = staging.stage_tall_csv(bronze, star.procedures(spark), "tall", (1, 2), False, FEATURED)
    return rounded(staged.drop(*_FILE_COLUMNS))


@query
def wide_csv_rates(spark, sf_dir):
    bronze = _with_run(read_price_csv(spark, files.wide_csv(spark, sf_dir))[1])
    staged = staging.stage_wide_csv(bronze, star.procedures(spark), "wide", (1, 2, 3, 4), CONFIG)
    return rounded(staged.drop(*_FILE_COLUMNS))


@query
def json_rates(spark, sf_dir):
    bronze = _with_run(price_json_items(spark, files.price_json(spark, sf_dir)))
    staged = staging.stage_json_items(bronze, star.procedures(spark), "json", CONFIG)
    return rounded(staged.drop(*_FILE_COLUMNS))


@query
def json_featured_rates(spark, sf_dir):
    """Featured scope: items that mention no featured code leave before they are parsed."""
    bronze = _with_run(price_json_items(spark, files.price_json(spark, sf_dir)))
    staged = staging.stage_json_items(bronze, star.procedures(spark), "json", FEATURED)
    return rounded(staged.drop(*_FILE_COLUMNS))


@query
def rates_from_files(spark, sf_dir):
    """Tall, wide and JSON files of all lines, one hospital each, to statistics by payer category.

    A hospital's date is the last one that any of its files states.
    """
    codes = star.procedures(spark)
    tall_paths, wide_paths = files.tall_csv(spark, sf_dir, 4), files.wide_csv(spark, sf_dir)
    json_paths = files.price_json(spark, sf_dir)

    def as_one_file(bronze: DataFrame, name: str) -> DataFrame:
        """Rows as a load writes them: the names and the rates are read from the table, not from the files again."""
        return write_stage(_with_run(bronze).withColumn("_source_file", F.lit(name)), "bronze-rates")

    tall = as_one_file(read_price_csv(spark, tall_paths)[1], "tall.csv")
    wide = as_one_file(read_price_csv(spark, wide_paths)[1], "wide.csv")
    nested = as_one_file(price_json_items(spark, json_paths), "prices.json")
    staged = [
        staging.stage_tall_csv(tall, codes, "tall", (1, 2, 3, 4), True, CONFIG),
        staging.stage_wide_csv(wide, codes, "wide", (1, 2, 3, 4), CONFIG),
        staging.stage_json_items(nested, codes, "json", CONFIG),
    ]
    crosswalk = spark.createDataFrame(
        [("tall", "000001", "Tall", "facility"), ("wide", "000002", "Wide", None), ("json", "000003", "Json", " ")], CROSSWALK
    )
    headers = silver.tagged_union({
        "tall": price_csv_headers(spark, tall_paths), "wide": price_csv_headers(spark, wide_paths),
        "json": price_json_headers(spark, json_paths),
    })
    rates = star.once(spark, sf_dir, "rates-from-files", lambda: silver.negotiated_rates(
        staged, crosswalk, silver.price_file_headers(headers), star.rules(spark), CONFIG, _ROWS_AT_ONCE
    ))
    return rounded(gold.price_by_payer_category(rates, CONFIG))


@query
def bronze_load(spark, sf_dir):
    """A load log and a bronze table in the catalog: appended, loaded once, reconciled, skipped when repeated."""
    database = "ratescope_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'bronze')}'")
    names = Schemas(bronze=database)
    tables.ensure_manifest(spark, names.log)
    tables.append_events(files.page_manifest(spark, sf_dir), names.log)
    spec = PageSetSpec("customers")
    build.load_page_set(spark, spec, names)
    if build.load_page_set(spark, spec, names) != tables.SKIPPED:
        raise RuntimeError("a repeated load was not skipped")
    bronze = spark.table(f"{database}.customers")
    return rounded(bronze.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
        fn.quoted("facility name").alias("facility_name"),
        fn.number_or_null(F.col("c_acctbal")).alias("c_acctbal"),
        F.col("_run_id").alias("run_id"),
        (F.col("_source_file").isNotNull() & F.col("_ingested_at").isNotNull()).alias("has_lineage"),
    ))


@query
def price_csv_records(spark, sf_dir):
    """Rows that the reader gives of the tall files against the record ends that the first pass finds in them."""
    paths = files.tall_csv(spark, sf_dir, 4)
    opened = open_price_csv(spark, paths, _SMALL_RANGES)
    rows = read_price_csv(spark, paths, opened=opened)[1]
    counted = opened.count() - N_LEADS * len(paths)
    return rows.agg(F.count("*").alias("n")).select(F.lit("rows").alias("kind"), "n").unionByName(
        spark.createDataFrame([("records", counted)], "kind string, n bigint")
    )


@query
def price_json_items_by_range(spark, sf_dir):
    """Items of the JSON documents, each read in many ranges, by their first code; and what the structure counts in all."""
    opened = open_price_json(spark, files.price_json(spark, sf_dir), _SMALL_RANGES)
    code = F.get_json_object("raw_json", "$.code_information[0].code")
    by_code = opened.items().groupBy(code.alias("code")).agg(F.count("*").alias("n_items"))
    return by_code.unionByName(spark.createDataFrame([("all items", opened.count())], "code string, n_items bigint"))


@query
def load_shortfall(spark, sf_dir):
    """A load that loses rows on its way: what the refusal states, and the earlier table as it still reads."""
    database = "ratescope_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'shortfall')}'")
    name = f"{database}.tall"
    paths = files.tall_csv(spark, sf_dir, 2)
    opened = open_price_csv(spark, paths)
    rows, expected = read_price_csv(spark, paths, opened=opened)[1], opened.count() - N_LEADS * len(paths)
    tables.load_table(rows, name, "run-1", expected=expected)
    try:
        tables.load_table(rows.where(F.col("setting") != "R"), name, "run-2", expected=expected)
        refusal = None
    except tables.ReconcileError as error:
        refusal = str(error).removeprefix(name)
    held = spark.table(name).groupBy(F.col("_run_id").alias("run_id"), "setting").agg(F.count("*").alias("n_rows"))
    return held.withColumn("refusal", F.lit(refusal))


@query
def csv_and_json_headers(spark, sf_dir):
    """Metadata name/value rows of every CSV and JSON file, distinct."""
    csv_rows = price_csv_headers(spark, files.tall_csv(spark, sf_dir, 2)).drop("_source_file")
    json_rows = price_json_headers(spark, files.price_json(spark, sf_dir)).drop("_source_file")
    return csv_rows.unionByName(json_rows).distinct()


@query
def paged_json_latest_run(spark, sf_dir):
    """The pages of the newest run in the load log, read as text and cast."""
    log = files.page_manifest(spark, sf_dir)
    paths = [r["landing_path"] for r in manifest.latest_run_pages(log).select("landing_path").collect()]
    rows = read_pages(spark, paths)
    return rounded(rows.select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"),
        fn.quoted("facility name").alias("facility_name"),
        fn.number_or_null(F.col("c_acctbal")).alias("c_acctbal"),
        fn.optional_column(rows, "C_MKTSEGMENT").alias("segment"),
        fn.optional_column(rows, "zip_code").alias("zip_code"),
    ))


@query
def paged_json_by_run_date(spark, sf_dir):
    """Pages of several dated runs by a glob; the date is a column, and a filter on it leaves whole folders unread."""
    base = files.dated_pages(spark, sf_dir)
    schema = "c_custkey string, c_name string, balance string, run_date string"
    rows = read_pages(spark, f"{base}/run_date=*", T.StructType.fromDDL(schema), base=base)
    return rounded(rows.where(F.col("run_date") >= F.lit("2025-01-03")).select(
        F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name", fn.number_or_null(F.col("balance")).alias("balance"),
        F.col("run_date").cast("string").alias("run_date"),
    ))


@query
def paged_json_fields(spark, sf_dir):
    """All dated pages without a schema: each page is parsed once, fields that only some rows have become columns."""
    base = files.dated_pages(spark, sf_dir)
    rows = read_pages(spark, f"{base}/run_date=*", base=base)
    return rows.groupBy("run_date").agg(
        F.count("c_custkey").alias("n_rows"), F.count("balance").alias("n_balances"), F.countDistinct("page").alias("n_pages")
    ).withColumn("run_date", F.col("run_date").cast("string"))


@query
def seed_file(spark, sf_dir):
    """A seed file with typed columns, quotes and commas."""
    schema = T.StructType.fromDDL("p_partkey bigint, name string, p_size int, p_retailprice double")
    return rounded(read_seed(spark, files.seed_csv(spark, sf_dir), schema))


# --------------------------------------------------------------------------------------- reshapes
@query
def code_slot_unpivot(spark, sf_dir):
    """Orders as code slots: priority, status and a blank."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("code|1"), F.lit("Priority").alias("code|1|type"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(F.lit(" ")).alias("code|2"),
        F.lit("status").alias("code|2|type"),
        F.col("o_orderpriority").alias("code|3"), F.lit("PRIORITY").alias("code|3|type"),
    )
    return reshape.explode_code_slots(orders, (1, 2, 3)).select("o_orderkey", "code", "code_type", "item_codes")


@query
def wide_unpivot(spark, sf_dir):
    """Line items with four metric columns for two payer/plans; one metric is missing for one of them."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").cast("string").alias("standard_charge|A / B|P|1|negotiated_dollar"),
        F.col("l_discount").cast("string").alias("standard_charge|A / B|P|1|negotiated_percentage"),
        F.col("l_returnflag").alias("standard_charge|A / B|P|1|methodology"),
        F.col("l_tax").cast("string").alias("standard_charge|C's|Q|negotiated_dollar"),
        F.col("l_linestatus").alias("standard_charge|C's|Q|negotiated_algorithm"),
        F.col("l_tax").cast("string").alias("standard_charge|negotiated_dollar"),
    )
    long = reshape.unpivot_payers(lines)
    return rounded(long.select(
        "l_orderkey", "l_linenumber", "payer_name", "plan_name",
        fn.number_or_null(F.col("dollar_raw")).alias("dollar"),
        fn.number_or_null(F.col("percentage_raw")).alias("percentage"),
        F.col("algorithm_raw").alias("algorithm"), F.col("methodology_raw").alias("methodology"),
    ))


@query
def nested_item_explode(spark, sf_dir):
    """Conversations as nested items: turns become charges and roles become codes, then come apart again."""
    turns = table(spark, sf_dir, "conversations")
    text = F.to_json(F.struct(
        F.col("text").alias("description"),
        F.array(F.struct(F.col("role").alias("code"), F.lit("role").alias("type"))).alias("code_information"),
        F.array(F.struct(
            F.col("turn").alias("setting"),
            F.array(F.struct(F.length("text").alias("standard_charge_dollar"))).alias("payers_information"),
        )).alias("standard_charges"),
    ))
    item = turns.select("conv_id", F.from_json(text, PRICE_ITEM).alias("item"))
    charges = item.select(
        "conv_id", F.col("item.description").alias("text"), fn.joined_codes(F.col("item.code_information")).alias("codes"),
        F.explode("item.standard_charges").alias("c"),
    )
    return charges.select(
        "conv_id", "text", "codes", F.col("c.setting").alias("turn"), F.explode("c.payers_information").alias("p")
    ).select("conv_id", "text", "codes", "turn", fn.number_or_null(F.col("p.standard_charge_dollar")).alias("n_chars"))


@query
def header_pivot(spark, sf_dir):
    """Orders of each customer as name/value rows, pivoted back by priority."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("source_key"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("header_name"),
        F.col("o_orderstatus").alias("header_value"),
    )
    return reshape.pivot_headers(rows, ["1-urgent", "5-low"]).select(
        "source_key", F.col("1-urgent").alias("urgent"), F.col("5-low").alias("low")
    )


# ----------------------------------------------------------------------- lookups, unions, scalars
@query
def label_and_scope(spark, sf_dir):
    """Parts labelled by code and case-insensitive type, every type kept."""
    from dataclasses import replace

    coded = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("code"), star.code_type(F.col("p_size")).alias("code_type")
    )
    return lookups.label_procedures(coded, star.procedures(spark), replace(CONFIG, silver_code_types=None))


@query
def label_and_scope_featured(spark, sf_dir):
    coded = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("code"), star.code_type(F.col("p_size")).alias("code_type")
    )
    return lookups.label_procedures(coded, star.procedures(spark), FEATURED)


@query
def mentioned_codes(spark, sf_dir):
    """Whole web pages that hold a language code in double quotes."""
    codes = spark.createDataFrame([("fr",), ("de",), (None,)], "code string")
    return lookups.mentioning_codes(table(spark, sf_dir, "pages"), "html", codes, CONFIG).select("page_id")


@query
def mentioned_codes_by_join(spark, sf_dir):
    """The same with a code list too long to inline: customer segments in the text of all items."""
    from dataclasses import replace

    codes = table(spark, sf_dir, "nation").select(F.col("n_name").alias("code"))
    items = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.to_json(F.struct(F.concat(F.lit("NATION_"), (F.col("c_nationkey") * 2).cast("string")).alias("code"))).alias("raw"),
    )
    return lookups.mentioning_codes(items, "raw", codes, replace(CONFIG, max_inline_rows=5)).select("c_custkey")


@query
def staged_union_distinct(spark, sf_dir):
    """Two overlapping sources with the same columns: UNION ALL, then distinct whole rows."""
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    return rounded(lines.unionByName(lines.select(*reversed(columns))).distinct())


@query
def payer_rules_by_join(spark, sf_dir):
    """Part names and brands matched by a rule table too long to inline."""
    from dataclasses import replace

    from ratescope.operators.payers import with_payer_category

    rules = spark.createDataFrame(
        [(2, "b", "^(red|blue) ", None), (1, "a", "blue b|gear", None), (3, "c", "brand 1", None), (1, "z", "bolt", None)],
        "priority int, category string, pattern string, note string",
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return with_payer_category(parts, rules, replace(CONFIG, max_inline_rows=1), "p_name", "p_brand")


@query
def safe_casts(spark, sf_dir):
    """Blank-to-null, safe numbers and safe ratios over odd number text made from line items."""
    n = F.col("l_linenumber")
    raw = (
        F.when(n == 1, F.lit("  ")).when(n == 2, F.lit("N/A")).when(n == 3, F.lit("12,5")).when(n == 4, F.lit("1e3"))
        .when(n == 5, F.lit(" -5 ")).otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("string")))
    )
    return rounded(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.text_or_null(raw).isNull().alias("blank"),
        fn.number_or_null(raw).alias("number"), fn.safe_ratio(F.col("l_tax"), F.col("l_discount")).alias("ratio"),
    ))


@query
def file_dates(spark, sf_dir):
    """Order dates in three spellings and some that are no date."""
    date = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format(date, "M/d/yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format(date, "MM/dd/yyyy"))
        .otherwise(F.lit("soon"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.parse_file_date(raw).alias("file_date"))


@query
def name_overlap(spark, sf_dir):
    """Part names that share a word of four letters or more with the hospital-like name given."""
    expected = F.lit("Large Widget Medical Center")
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.names_overlap(F.concat(F.col("p_name"), F.lit(" medical")), expected).alias("same_name"),
        F.size(fn.name_tokens(F.col("p_name"))).alias("n_tokens"),
    )


@query
def run_ids(spark, sf_dir):
    """Run ids in landing paths, and paths without one."""
    path = F.when(F.col("event_id") % 3 > 0, F.col("landing_path")).otherwise(F.lit("/landing/f.csv"))
    log = files.event_manifest(spark, sf_dir).withColumn("event_id", F.regexp_extract("landing_path", "r(\\d+)", 1).cast("int"))
    return log.select("event_id", fn.run_id_from_path(path).alias("run_id"))


# --------------------------------------------------------------------------------------- load log
def _wall_clock(df: DataFrame) -> DataFrame:
    """Event times as the tables show them, whatever the session's time zone."""
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query
def last_downloads(spark, sf_dir):
    return _wall_clock(manifest.last_downloads(files.event_manifest(spark, sf_dir)).drop("sha256"))


@query
def latest_run_pages(spark, sf_dir):
    return manifest.expected_rows(manifest.latest_run_pages(files.event_manifest(spark, sf_dir)))


@query
def run_summary(spark, sf_dir):
    return manifest.run_summary(files.event_manifest(spark, sf_dir))


@query
def rows_and_pages(spark, sf_dir):
    return manifest.rows_and_pages(files.event_manifest(spark, sf_dir))


@query
def event_history(spark, sf_dir):
    return _wall_clock(manifest.event_history(files.event_manifest(spark, sf_dir), "key-8"))


@query
def latest_run_events(spark, sf_dir):
    return _wall_clock(manifest.latest_run_events(files.event_manifest(spark, sf_dir)).select(
        "run_id", "dataset_key", "status", "event_ts"
    ))


@query
def refresh_decisions(spark, sf_dir):
    """One decision per file key; what the server says now varies by key."""
    log = files.event_manifest(spark, sf_dir)
    downloads = manifest.last_downloads(log)
    k = F.regexp_extract("dataset_key", "(\\d+)", 1).cast("int")
    known = log.filter(F.col("source") == "hospital_price_file").select("dataset_key").distinct()
    observed = known.join(downloads.select("dataset_key", "file_bytes"), "dataset_key", "left").select(
        "dataset_key",
        (k % 40 == 0).alias("forced"),
        F.when(k % 14 > 0, F.coalesce("file_bytes", F.lit(7))).alias("disk_bytes"),
        (k % 18 > 0).alias("headers_read"),
        F.when(k % 4 == 0, F.lit("e0")).alias("etag"),
        F.when(k % 6 == 0, F.lit("Wed, 10 Jan 2024 10:00:00 GMT"))
        .when(k % 6 == 2, F.lit("Mon, 01 Jan 2024 10:00:00 GMT"))
        .alias("last_modified"),
        F.when(k % 10 == 0, F.lit("12x")).alias("content_length"),
    )
    return manifest.refresh_decisions(downloads, observed, F.to_timestamp(F.lit("2024-02-27 00:00:00")))


# ---------------------------------------------------------------------------------- data quality
@query
def dq_not_null(spark, sf_dir):
    rates = star.rates(spark, sf_dir)
    return quality.null_rows(rates, "plan_name").groupBy("source_key").agg(F.count("*").alias("n_rows"))


@query
def dq_unique(spark, sf_dir):
    return quality.repeated_values(table(spark, sf_dir, "orders"), "o_custkey")


@query
def dq_accepted_values(spark, sf_dir):
    return quality.unaccepted_values(table(spark, sf_dir, "events"), "event_type", ["view", "click", "signup"])


@query
def dq_relationships(spark, sf_dir):
    """Documents without a label."""
    return quality.orphans(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query
def dq_unique_combination(spark, sf_dir):
    columns = ["source_key", "code_type", "code", "setting", "billing_class", "modifiers", "payer_name", "plan_name"]
    return quality.repeated_combinations(star.rates(spark, sf_dir), columns)


@query
def dq_negative_rates(spark, sf_dir):
    accounts = table(spark, sf_dir, "customer").withColumn("negotiated_dollar", F.col("c_acctbal") - 2000)
    return rounded(quality.negative_rates(accounts).select("c_custkey", "negotiated_dollar"))


@query
def dq_report(spark, sf_dir):
    """Declared checks of two tables as one results table; each table is scanned twice at most."""
    rates, variation = star.rates(spark, sf_dir), stored_variation(spark, sf_dir)
    hospitals = star.hospitals(spark, sf_dir)
    return quality.report([
        quality.table_checks(
            rates, "rates", quality.not_null("code", "file_last_updated_on"),
            quality.no_negative("negotiated_dollar", "no_negative_dollar_rates"),
            quality.related("hospital_ccn", hospitals, "hospital_ccn"),
            quality.unique_together(["source_key", "code", "payer_name", "plan_name"], quality.WARN),
        ),
        quality.table_checks(variation, "variation", quality.ordered_spread()),
    ])


@query
def dq_table_checks(spark, sf_dir):
    """Checks of orders, events and documents: rows, key sets and parents of one table side by side."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.report([
        quality.table_checks(
            orders, "orders", quality.not_null("o_custkey", "o_orderstatus"), quality.unique("o_orderkey", "o_custkey"),
            quality.accepted("o_orderpriority", ["1-URGENT", "5-LOW"]), quality.accepted("o_orderstatus", ["F", "O"]),
            quality.unique_together(["o_custkey", "o_orderstatus"], quality.WARN), quality.unique_together(["o_orderkey", "o_orderstatus"]),
            quality.related("o_custkey", table(spark, sf_dir, "customer"), "c_custkey"),
        ),
        quality.table_checks(
            events, "events", quality.accepted("event_type", ["view", "click", "signup"]), quality.unique("user_id"),
            quality.related("user_id", orders, "o_custkey", quality.WARN),
        ),
        quality.table_checks(documents, "documents", quality.unique("doc_id"), quality.related("doc_id", labels, "doc_id")),
    ])


@query
def page_reconciliation(spark, sf_dir):
    """All page checks of a run over two sets of customer pages, against a log with faults."""
    log = files.faulty_page_log(spark, sf_dir)
    paths = files.customer_pages(spark, sf_dir, "run-a") + files.customer_pages(spark, sf_dir, "run-b")
    contents = quality.page_contents(spark, paths)
    requirements = spark.createDataFrame(
        [("a", 1_000_000, ["C_CUSTKEY", "zip"]), ("b", 1, [])], "dataset_key string, min_rows bigint, required_columns array<string>"
    )
    return quality.page_checks(log, "r", contents.select("path"), contents, requirements).drop("detail")


@query
def page_contiguity(spark, sf_dir):
    """Page checks of every dataset key in one run of the event log: gaps, failures, missing files."""
    log = files.event_manifest(spark, sf_dir).withColumn("run_id", F.lit("all"))
    none = log.select(F.col("landing_path").alias("path")).filter(F.lit(False))
    contents = none.select(
        "path", F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_corrupt"),
        F.array().cast("array<string>").alias("columns"),
    )
    requirements = log.select("dataset_key").distinct().select(
        "dataset_key", F.lit(1).cast("bigint").alias("min_rows"), F.array().cast("array<string>").alias("required_columns")
    )
    return quality.page_checks(log, "all", none, contents, requirements).drop("detail")


@query
def file_reconciliation(spark, sf_dir):
    """All file checks over small price files, one key per file, against a log with faults."""
    paths = files.small_files(spark, sf_dir)
    facts = quality.file_facts(spark, paths)
    log = files.small_file_log(spark, sf_dir, paths)
    number = F.substring("dataset_key", 2, 20).cast("bigint")
    specs = log.select("dataset_key").distinct().select(
        "dataset_key", F.lit("The Riverside General Hospital").alias("hospital_name"), F.lit("csv").alias("file_format"),
        F.when(number % 7 == 6, 1_000_000_000).otherwise(10).alias("min_bytes"),
    )
    return quality.file_checks(log, "r", facts, specs).drop("detail")


@query
def file_digests(spark, sf_dir):
    """Size and SHA-256 of written files, read block by block."""
    facts = quality.file_facts(spark, files.small_files(spark, sf_dir))
    return facts.select(F.regexp_extract("path", "file=(\\d+)", 1).cast("bigint").alias("file"), "length", "sha256")


@query
def payload_sniffing(spark, sf_dir):
    """What whole web pages look like when a data file is expected."""
    pages = table(spark, sf_dir, "pages")
    fmt = F.when(F.col("page_id") % 3 == 0, F.lit("csv")).when(F.col("page_id") % 3 == 1, F.lit("json")).otherwise(F.lit("zip"))
    text = (
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("\ufeff [1] "), F.col("url")))
        .when(F.col("page_id") % 5 == 0, F.concat(F.lit("\ufeff  "), F.col("html")))
        .when(F.col("page_id") % 11 == 0, F.lit(""))
        .when(F.col("page_id") % 13 == 0, F.concat(F.lit("PK"), F.col("url")))
        .otherwise(F.col("html"))
    )
    head = F.encode(text, "UTF-8")
    return pages.select("page_id", quality.head_problem(fmt, head).alias("problem"))
