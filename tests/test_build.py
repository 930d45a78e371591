"""The whole build over catalog tables, from landed files and a load log to gold tables and checks."""

import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ratescope import schemas
from ratescope.config import PRICE_FILES, PageSetSpec, PipelineConfig
from ratescope.plans import build, quality
from ratescope.plans.build import Schemas
from ratescope.sinks import tables
from tests import fixtures as fx

NAMES = Schemas("tb_bronze", "tb_silver", "tb_gold")
RUN = "run-1"
PAGE_SETS = tuple(
    PageSetSpec(k, min_rows=1)
    for k in ("hospital_general_information", "unplanned_hospital_visits", "complications_and_deaths")
)
# The fixtures have two code slots.
FILES = tuple(replace(f, code_slots=(1, 2)) if f.code_slots else f for f in PRICE_FILES)

PAGES = {
    "hospital_general_information": [
        [{"facility_id": "440039", "facility_name": "A", "state": "TN", "countyparish": "DAVIDSON"}],
        [{"facility_id": "440053", "facility_name": "B", "state": "TN"}, {"facility_id": "000001", "facility_name": "C", "state": "KY"}],
    ],
    "unplanned_hospital_visits": [[
        {"facility_id": "440039", "measure_id": "READM_30_HIP_KNEE", "score": "5.1", "end_date": "06/30/2025", "denominator": "80"},
        {"facility_id": "440039", "measure_id": "READM_30_HIP_KNEE", "score": "4.0", "end_date": "09/30/2024", "denominator": "70"},
        {"facility_id": "440053", "measure_id": "readm_30_hip_knee", "score": "Not Available", "end_date": "06/30/2025"},
        {"facility_id": "440039", "measure_id": "READM_30_AMI", "score": "9", "end_date": "12/31/2025"},
    ]],
    "complications_and_deaths": [[
        {"facility_id": "440039", "measure_id": "COMP_HIP_KNEE", "score": "2.5", "end_date": "03/31/2025"},
        {"facility_id": "440029", "measure_id": "COMP_HIP_KNEE", "score": "3.5", "end_date": "03/31/2025"},
    ]],
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for s in (NAMES.bronze, NAMES.silver, NAMES.gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {s} LOCATION '{root}/{s}'")
    at = datetime(2026, 1, 1)
    events = []
    for key, pages in PAGES.items():
        for i, rows in enumerate(pages):
            path = fx.write(root, f"{key}/run_date=2026-01-01/page_{i:05}.json", json.dumps(rows))
            events.append((RUN, key, "provider_data_catalog", i, len(rows), "succeeded", path, at))
    texts = {"vumc_mrf": fx.TALL, "struth_mrf": fx.TALL, "wmc_mrf": fx.WIDE, "sthss_mrf": fx.price_json()}
    for f in FILES:
        path = fx.write(root, f"files/{f.key}/run_id={RUN}/{f.key}.{f.file_format}", texts[f.key])
        events.append((RUN, f.key, schemas.PRICE_FILE_SOURCE, None, None, "succeeded", path, at))
    tables.ensure_manifest(spark, NAMES.log)
    log = spark.createDataFrame(
        events, "run_id string, dataset_key string, source string, page_number int, row_count int, status string, "
        "landing_path string, event_ts timestamp",
    )
    tables.append_events(log, NAMES.log)
    yield root
    for s in (NAMES.bronze, NAMES.silver, NAMES.gold):
        spark.sql(f"DROP DATABASE IF EXISTS {s} CASCADE")


def test_build(spark, landed):
    loaded = build.load_bronze(spark, NAMES, PAGE_SETS, FILES)
    assert loaded == {
        "hospital_general_information": 3, "unplanned_hospital_visits": 4, "complications_and_deaths": 2,
        "vumc_mrf": 6, "sthss_mrf": 5, "struth_mrf": 6, "wmc_mrf": 3,
    }
    assert set(build.load_bronze(spark, NAMES, PAGE_SETS, FILES).values()) == {tables.SKIPPED}
    assert spark.table(f"{NAMES.bronze}.wmc_mrf").columns[-3:] == list(schemas.LINEAGE_COLUMNS)

    results = build.build_models(spark, NAMES, PipelineConfig(min_payer_plans_for_comparison=1), FILES)
    by_status = {}
    for r in results.collect():
        by_status.setdefault(r["status"], set()).add((r["subject"], r["check_name"]))
    assert quality.FAIL not in by_status, by_status
    # Two crosswalk hospitals are not in the general information.
    assert by_status[quality.WARN] == {("hospital_crosswalk", "relationships hospital_ccn")}
    quality.raise_on_failure(results)

    rates = spark.table(f"{NAMES.silver}.silver_negotiated_rates")
    assert rates.count() == 16
    # This file is read as having no billing class, so the documented assumption fills it in.
    assert {(r["billing_class"], r["billing_class_assumed"]) for r in rates.filter("source_key = 'struth_mrf'").collect()} == {
        ("facility", True)
    }
    kinds = {r["rate_type"]: r["count"] for r in rates.groupBy("rate_type").count().collect()}
    assert kinds == {"dollar": 4, "percentage": 4, "algorithm": 4, "none": 4}
    assert {str(r["file_last_updated_on"]) for r in rates.collect()} == {"2026-01-01", "2025-10-01"}

    variation = spark.table(f"{NAMES.gold}.gold_price_variation")
    knee = variation.filter("code = '27447' and hospital_ccn = '440039'").first()
    assert (knee["n_dollar_rates"], knee["median_rate"], knee["n_percentage_rates"], knee["county"]) == (1, 20000.5, 1, "DAVIDSON")
    hip = variation.filter("code = '27130' and hospital_ccn = '440039'").first()
    assert (hip["n_dollar_rates"], hip["median_rate"], hip["spread_ratio"], hip["n_algorithm_rates"]) == (0, None, None, 1)

    dim = {r["hospital_ccn"]: r for r in spark.table(f"{NAMES.gold}.dim_hospital").collect()}
    assert len(dim) == 4 and dim["440039"]["has_cms_readmission_data"] and not dim["440053"]["has_cms_readmission_data"]
    # A hospital with a complication row only has no outcome row.
    assert not dim["440029"]["has_cms_complication_data"] and not dim["440029"]["in_cms_general_info"]

    outcome = spark.table(f"{NAMES.silver}.stg_cms_outcomes").filter("hospital_ccn = '440039'").first()
    # The latest row is chosen by the text of its date.
    assert (outcome["readmission_rate"], outcome["readmission_end_date"], outcome["complication_rate"]) == (4.0, "09/30/2024", 2.5)

    across = spark.table(f"{NAMES.gold}.gold_price_variation_across_hospitals")
    assert across.filter("code = '27447'").agg(F.sum("n_hospitals")).first()[0] == 4
    gap = spark.table(f"{NAMES.gold}.gold_payer_category_gap").filter("hospital_ccn = '440039' and code = '27447'").first()
    assert (gap["commercial_median"], gap["medicaid_median"], gap["medicaid_to_commercial"]) == (20000.5, None, None)
    both = spark.table(f"{NAMES.gold}.gold_price_vs_readmission")
    assert {r["readmission_reported"] for r in both.collect()} == {True, False}


def test_a_failing_table_does_not_stop_the_others(spark, landed):
    extra = replace(FILES[0], key="missing_mrf")
    with pytest.raises(build.LoadError, match="missing_mrf: LoadError: missing_mrf: no successful download"):
        build.load_bronze(spark, NAMES, (), (extra, *FILES), force=True)
    assert spark.catalog.tableExists(f"{NAMES.bronze}.wmc_mrf")


def test_row_counts_are_reconciled(spark, landed):
    log = spark.table(NAMES.log).filter("dataset_key = 'hospital_general_information'")
    newer = log.withColumns({
        "run_id": F.lit("run-2"), "event_ts": F.to_timestamp(F.lit("2026-02-01")), "row_count": F.lit(5),
    })
    tables.append_events(spark.createDataFrame(newer.collect(), schemas.MANIFEST), NAMES.log)
    table = f"{NAMES.bronze}.hospital_general_information"
    before = sorted(map(str, spark.table(table).collect()))
    with pytest.raises(tables.ReconcileError, match="has 3 rows where its source states 10"):
        build.load_page_set(spark, PAGE_SETS[0], NAMES)
    # The earlier table is as it was, and nothing is left of the load that failed.
    assert sorted(map(str, spark.table(table).collect())) == before and len(before) == 3
    assert not [t.name for t in spark.catalog.listTables(NAMES.bronze) if "__" in t.name]


def test_a_write_that_breaks_off_leaves_the_table(spark, landed):
    table = f"{NAMES.bronze}.kept"
    assert tables.rebuild_table(spark.range(5), table) == 5
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("torn"))).otherwise(F.col("id")).alias("other"))
    with pytest.raises(Exception, match="torn"):
        tables.rebuild_table(broken, table)
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 5
    assert tables.rebuild_table(spark.range(3).toDF("other"), table, expected=3) == 3
    assert spark.table(table).columns == ["other"]


def test_manifest_gains_columns(spark, landed):
    old = f"{NAMES.bronze}.old_log"
    early = [f.name for f in schemas.MANIFEST.fields][:9]
    spark.createDataFrame([], schemas.MANIFEST).select(*early).write.saveAsTable(old)
    tables.ensure_manifest(spark, old)
    assert spark.table(old).columns == schemas.MANIFEST.names
    tables.ensure_manifest(spark, old)
    assert spark.table(old).count() == 0
