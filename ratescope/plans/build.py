"""The whole build over catalog tables: landed files -> bronze -> silver -> gold -> checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratescope.config import PAGE_SETS, PRICE_FILES, PageSetSpec, PipelineConfig, PriceFileSpec
from ratescope.functions import run_id_from_path
from ratescope.plans import gold, quality, silver, staging
from ratescope.plans.manifest import last_downloads, latest_run_pages
from ratescope.schemas import HEADER
from ratescope.sinks.tables import SKIPPED, is_loaded, load_table, rebuild_table, with_lineage
from ratescope.sources.pages import default_crosswalk, default_payer_rules, default_procedure_codes, read_pages
from ratescope.sources.price_csv import LayoutError, N_LEADS, open_price_csv, price_csv_header, read_price_csv
from ratescope.sources.price_json import open_price_json, price_json_headers


class LoadError(RuntimeError):
    """One or more bronze tables could not be loaded."""


@dataclass(frozen=True)
class Schemas:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    manifest: str = "ingestion_manifest"

    @property
    def log(self) -> str:
        return f"{self.bronze}.{self.manifest}"


def load_page_set(spark: SparkSession, spec: PageSetSpec, names: Schemas, force: bool = False) -> int | str:
    """Bronze table of a paged dataset, from the pages of its newest run."""
    log = spark.table(names.log).filter(F.col("dataset_key") == spec.key)
    pages = latest_run_pages(log).select("run_id", "landing_path", "row_count").collect()
    if not pages:
        raise LoadError(f"{spec.key}: no succeeded pages in the load log")
    table, run_id = f"{names.bronze}.{spec.key}", pages[0]["run_id"]
    if not force and is_loaded(spark, table, run_id):
        return SKIPPED
    records = read_pages(spark, sorted(p["landing_path"] for p in pages))
    return load_table(records, table, run_id, expected=sum(p["row_count"] or 0 for p in pages))


def load_price_file(spark: SparkSession, spec: PriceFileSpec, names: Schemas, force: bool = False) -> int | str:
    """Bronze table and header table of a price file, from its last download."""
    if spec.file_format not in ("csv", "json"):
        raise LoadError(f"{spec.key}: '{spec.file_format}' price files cannot be loaded")
    log = spark.table(names.log).filter(F.col("dataset_key") == spec.key)
    found = last_downloads(log).select("landing_path", run_id_from_path(F.col("landing_path")).alias("run_id")).first()
    if found is None:
        raise LoadError(f"{spec.key}: no successful download in the load log")
    path, run_id, table = found["landing_path"], found["run_id"], f"{names.bronze}.{spec.key}"
    if not force and is_loaded(spark, table, run_id):
        return SKIPPED
    if spec.file_format == "csv":
        opened = open_price_csv(spark, [path])
        rows, header = read_price_csv(spark, [path], opened=opened)[1], price_csv_header(spark, path)
        expected = opened.count() - N_LEADS
    else:
        opened = open_price_json(spark, [path])
        rows, header = opened.items(), price_json_headers(spark, [path]).select(*HEADER.names)
        expected = opened.count()
    loaded = load_table(rows, table, run_id, expected=expected)
    rebuild_table(with_lineage(header, F.lit(path), run_id), f"{table}_header")
    return loaded


def load_bronze(
    spark: SparkSession,
    names: Schemas = Schemas(),
    page_sets: Sequence[PageSetSpec] = PAGE_SETS,
    price_files: Sequence[PriceFileSpec] = PRICE_FILES,
    force: bool = False,
) -> dict[str, int | str]:
    """Load every bronze table. A failing one does not stop the others; failures are raised at the end."""
    outcome: dict[str, int | str] = {}
    failures: dict[str, Exception] = {}
    for load, specs in ((load_page_set, page_sets), (load_price_file, price_files)):
        for spec in specs:
            try:
                outcome[spec.key] = load(spark, spec, names, force)
            except Exception as error:  # noqa: BLE001 - every table is tried, then all failures are raised
                failures[spec.key] = error
    if failures:
        raise LoadError("; ".join(f"{k}: {type(e).__name__}: {e}" for k, e in failures.items()))
    return outcome


def stage(
    spark: SparkSession, spec: PriceFileSpec, procedure_codes: DataFrame, names: Schemas, cfg: PipelineConfig
) -> DataFrame:
    bronze = spark.table(f"{names.bronze}.{spec.key}")
    if spec.layout == "tall":
        return staging.stage_tall_csv(
            bronze, procedure_codes, spec.key, spec.code_slots, spec.has_billing_class, cfg
        )
    if spec.layout == "wide":
        return staging.stage_wide_csv(bronze, procedure_codes, spec.key, spec.code_slots, cfg)
    if spec.layout == "json":
        return staging.stage_json_items(bronze, procedure_codes, spec.key, cfg)
    raise LayoutError(f"{spec.key}: unknown layout {spec.layout!r}")


def build_models(
    spark: SparkSession,
    names: Schemas = Schemas(),
    cfg: PipelineConfig = PipelineConfig(),
    price_files: Sequence[PriceFileSpec] = PRICE_FILES,
    crosswalk: DataFrame | None = None,
    procedure_codes: DataFrame | None = None,
    payer_rules: DataFrame | None = None,
) -> DataFrame:
    """Write silver and gold tables from bronze and return the check results.

    The rates table and each gold table that feeds another one are read back from storage, so every
    source is parsed once and group sizes come from stored row counts.
    """
    crosswalk = default_crosswalk(spark) if crosswalk is None else crosswalk
    procedure_codes = default_procedure_codes(spark) if procedure_codes is None else procedure_codes
    payer_rules = default_payer_rules(spark) if payer_rules is None else payer_rules

    def save(df: DataFrame, schema: str, name: str) -> DataFrame:
        rebuild_table(df, f"{schema}.{name}")
        return spark.table(f"{schema}.{name}")

    header_tables = {f.key: spark.table(f"{names.bronze}.{f.key}_header") for f in price_files}
    headers = save(
        silver.price_file_headers(silver.tagged_union(header_tables)), names.silver, "stg_price_file_headers"
    )
    staged = [stage(spark, f, procedure_codes, names, cfg) for f in price_files]
    rates = save(
        silver.negotiated_rates(staged, crosswalk, headers, payer_rules, cfg), names.silver, "silver_negotiated_rates"
    )
    general = spark.table(f"{names.bronze}.hospital_general_information")
    cms = silver.cms_hospitals(general)
    outcomes = save(
        silver.cms_outcomes(
            spark.table(f"{names.bronze}.unplanned_hospital_visits"),
            spark.table(f"{names.bronze}.complications_and_deaths"),
        ),
        names.silver, "stg_cms_outcomes",
    )
    hospitals = save(gold.hospital_dimension(crosswalk, cms, outcomes, headers), names.gold, "dim_hospital")
    variation = save(gold.price_variation(rates, hospitals, cfg), names.gold, "gold_price_variation")
    by_category = save(gold.price_by_payer_category(rates, cfg), names.gold, "gold_price_by_payer_category")
    across = save(
        gold.variation_across_hospitals(variation, cfg), names.gold, "gold_price_variation_across_hospitals"
    )
    save(gold.hospital_comparison(by_category, cfg), names.gold, "gold_hospital_comparison_by_payer_category")
    save(gold.payer_category_gap(by_category), names.gold, "gold_payer_category_gap")
    readmission = save(
        gold.price_vs_readmission(variation, outcomes), names.gold, "gold_price_vs_readmission"
    )
    items = {
        f.key: spark.table(f"{names.bronze}.{f.key}") for f in price_files if f.layout == "json"
    }
    return quality.model_checks(
        rates, variation, hospitals, crosswalk, headers, cms, outcomes, across, readmission, procedure_codes,
        general, items,
    )
