"""One DuckDB statement per registered query, with the same column names."""

from __future__ import annotations

from ratescope.workload.oracle import (
    BY_CATEGORY_CTE,
    CMS_CTE,
    CROSSWALK_CTE,
    HEADERS_CTE,
    HOSPITALS_CTE,
    OUTCOMES_CTE,
    PAYERS_CTE,
    RATES_CTE,
    STAGED_CTE,
    VARIATION_CTE,
)


def _round(*columns: str) -> str:
    return "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in columns) + ")"


_SPREAD = ("min_rate", "p25_rate", "median_rate", "p75_rate", "max_rate")
_ACROSS = (
    "lowest_hospital_median", "median_of_hospital_medians", "highest_hospital_median", "hospital_spread_ratio"
)


def _across(source: str, keys: str, count: str, minimum: int) -> str:
    return f"""
across AS (
  SELECT {keys}, max(procedure_label) AS procedure_label, max(item_description) AS item_description,
    count(*) AS n_hospitals, {minimum} AS min_payer_plans_required, min(file_last_updated_on) AS oldest_file_date,
    max(file_last_updated_on) AS newest_file_date, min(median_rate) AS lowest_hospital_median,
    quantile_cont(median_rate, 0.5) AS median_of_hospital_medians, max(median_rate) AS highest_hospital_median,
    max(median_rate) / nullif(min(median_rate), 0) AS hospital_spread_ratio
  FROM {source} WHERE {count} >= {minimum} GROUP BY {keys}
)"""


_ACROSS_VARIATION = _across("variation", "code_family, code, setting, billing_class", "n_dollar_rates", 5)
_ACROSS_CATEGORY = _across(
    "by_category", "code_family, code, setting, billing_class, payer_category", "n_payer_plans", 3
)

_GAP = """
SELECT hospital_ccn, hospital_name, code_family, code, setting, billing_class, max(procedure_label) AS procedure_label,
  max(file_last_updated_on) AS file_last_updated_on,
  round(max(median_rate) FILTER (WHERE payer_category = 'commercial'), 6) AS commercial_median,
  max(n_payer_plans) FILTER (WHERE payer_category = 'commercial') AS commercial_n,
  round(max(median_rate) FILTER (WHERE payer_category = 'exchange'), 6) AS exchange_median,
  max(n_payer_plans) FILTER (WHERE payer_category = 'exchange') AS exchange_n,
  round(max(median_rate) FILTER (WHERE payer_category = 'medicare_advantage'), 6) AS medicare_advantage_median,
  max(n_payer_plans) FILTER (WHERE payer_category = 'medicare_advantage') AS medicare_advantage_n,
  round(max(median_rate) FILTER (WHERE payer_category = 'medicaid'), 6) AS medicaid_median,
  max(n_payer_plans) FILTER (WHERE payer_category = 'medicaid') AS medicaid_n,
  round(max(median_rate) FILTER (WHERE payer_category = 'exchange')
    / nullif(max(median_rate) FILTER (WHERE payer_category = 'commercial'), 0), 6) AS exchange_to_commercial,
  round(max(median_rate) FILTER (WHERE payer_category = 'medicare_advantage')
    / nullif(max(median_rate) FILTER (WHERE payer_category = 'commercial'), 0), 6) AS medicare_advantage_to_commercial,
  round(max(median_rate) FILTER (WHERE payer_category = 'medicaid')
    / nullif(max(median_rate) FILTER (WHERE payer_category = 'commercial'), 0), 6) AS medicaid_to_commercial
FROM by_category GROUP BY ALL"""


def _quartiles(key: str) -> str:
    return f"""SELECT {key}, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25_price,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS median_price,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS p75_price,
  round(quantile_cont(CASE WHEN l_quantity > 25 THEN l_tax END, 0.5), 6) AS median_tax
FROM lineitem GROUP BY {key}"""


# The grain of the duplicate diagnostics once plans and items are dropped.
_DUP = "source_key, code_type, code, setting, billing_class, payer_name"
_USABLE = "rate_type = 'dollar' AND NOT is_placeholder_rate"

EXPECTED: dict[str, str] = {
    "rates_by_payer_category": f"WITH {BY_CATEGORY_CTE} SELECT {_round(*_SPREAD)} FROM by_category",
    "rates_by_payer_category_hot_groups": f"WITH {BY_CATEGORY_CTE} SELECT {_round(*_SPREAD)} FROM by_category",
    "price_variation": f"WITH {VARIATION_CTE} SELECT {_round(*_SPREAD, 'spread_ratio')} FROM variation",
    "variation_across_hospitals": f"WITH {VARIATION_CTE}, {_ACROSS_VARIATION} SELECT {_round(*_ACROSS)} FROM across",
    "hospital_comparison": f"WITH {BY_CATEGORY_CTE}, {_ACROSS_CATEGORY} SELECT {_round(*_ACROSS)} FROM across",
    "payer_category_gap": f"WITH {BY_CATEGORY_CTE} {_GAP}",
    "price_vs_readmission": f"""WITH {VARIATION_CTE}
SELECT v.hospital_ccn, v.hospital_name, v.procedure_label, v.code_family, v.code, v.setting, v.billing_class,
  v.billing_class_assumed, round(v.median_rate, 6) AS median_rate, v.n_dollar_rates, v.file_last_updated_on, v.county,
  v.hospital_type, v.hospital_ownership, o.readmission_rate, o.readmission_lower, o.readmission_upper,
  o.readmission_denominator, o.readmission_vs_national, o.readmission_footnote,
  coalesce(o.readmission_reported, FALSE) AS readmission_reported, o.readmission_start_date, o.readmission_end_date,
  o.complication_rate
FROM variation v LEFT JOIN outcomes o ON v.hospital_ccn = o.hospital_ccn
WHERE v.procedure_label IS NOT NULL AND v.n_dollar_rates > 0""",
    "hospital_dimension": f"WITH {CROSSWALK_CTE}, {CMS_CTE}, {OUTCOMES_CTE}, {HEADERS_CTE}, {HOSPITALS_CTE} "
    "SELECT * FROM hospitals",
    "outcome_latest": f"WITH {OUTCOMES_CTE} SELECT * FROM outcomes",
    "cms_hospitals": f"WITH {CMS_CTE} SELECT * FROM cms",
    "price_file_headers": f"WITH {HEADERS_CTE} SELECT * FROM headers",
    "payer_categories": f"WITH {STAGED_CTE}, {PAYERS_CTE} SELECT * FROM payer_categories",
    "negotiated_rates": f"""WITH {RATES_CTE}
SELECT {_round("negotiated_dollar", "negotiated_percentage", "gross_charge", "min_charge", "max_charge")} FROM rates""",
    "commercial_prices": f"""WITH {BY_CATEGORY_CTE}
SELECT hospital_name, procedure_label, round(median_rate, 6) AS median_rate, round(p25_rate, 6) AS p25_rate,
  round(p75_rate, 6) AS p75_rate, round(min_rate, 6) AS min_rate, round(max_rate, 6) AS max_rate, n_payer_plans,
  file_last_updated_on
FROM by_category WHERE payer_category = 'commercial' AND billing_class = 'f' AND setting = 'a'
  AND code IN ('SMALL', 'LARGE') AND n_payer_plans >= 3""",
    "price_by_category": f"""WITH {BY_CATEGORY_CTE}
SELECT hospital_name, payer_category, round(median_rate, 6) AS median_rate, n_payer_plans
FROM by_category WHERE code = 'SMALL' AND billing_class = 'f' AND setting = 'a' AND median_rate IS NOT NULL""",
    "hospital_finder": """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS facility_id, c_name AS facility_name,
  c_mktsegment AS hospital_type
FROM customer WHERE regexp_matches(lower(c_name), 'customer#0000000[12]|77$') AND c_nationkey < 13""",
    "exact_percentiles": _quartiles("l_suppkey"),
    "exact_percentiles_hot_groups": _quartiles("l_returnflag"),
    "duplicates_by_source": f"""WITH {RATES_CTE},
dups AS (
  SELECT {_DUP}, count(DISTINCT negotiated_dollar) AS d FROM rates GROUP BY {_DUP} HAVING count(*) > 1
)
SELECT source_key, count(*) AS duplicate_groups, count(*) FILTER (WHERE d <= 1) AS identical_amount_groups
FROM dups GROUP BY source_key""",
    "duplicate_differences": f"""WITH {RATES_CTE},
g AS (
  SELECT {_DUP}, modifiers, count(DISTINCT negotiated_dollar) AS d_dollar, count(DISTINCT methodology) AS d_methodology,
    count(DISTINCT gross_charge) AS d_gross, count(DISTINCT min_charge) AS d_min, count(DISTINCT max_charge) AS d_max,
    count(DISTINCT rate_type) AS d_rate_type
  FROM rates GROUP BY {_DUP}, modifiers HAVING count(*) > 1
)
SELECT source_key, count(*) AS dup_groups, count(*) FILTER (WHERE d_dollar > 1) AS different_dollar_amounts,
  count(*) FILTER (WHERE d_methodology > 1) AS different_methodology,
  count(*) FILTER (WHERE d_gross > 1 OR d_min > 1 OR d_max > 1) AS different_charges,
  count(*) FILTER (WHERE d_rate_type > 1) AS mixed_rate_types
FROM g GROUP BY source_key""",
    "duplicate_sample": f"""WITH {RATES_CTE},
dup_rows AS (SELECT *, count(*) OVER (PARTITION BY {_DUP}) AS n_in_group FROM rates),
numbered AS (
  SELECT *, dense_rank() OVER (
    PARTITION BY source_key ORDER BY code NULLS FIRST, payer_name NULLS FIRST, setting NULLS FIRST) AS grp
  FROM dup_rows WHERE n_in_group > 1
)
SELECT source_key, CAST(grp AS INTEGER) AS grp, code, setting, billing_class, payer_name,
  CAST(NULL AS VARCHAR) AS plan_name, rate_type, round(negotiated_dollar, 6) AS negotiated_dollar,
  round(negotiated_percentage, 6) AS negotiated_percentage, methodology, round(gross_charge, 6) AS gross_charge,
  round(min_charge, 6) AS min_charge, round(max_charge, 6) AS max_charge
FROM numbered WHERE grp <= 3""",
    "rate_spread": f"""WITH {RATES_CTE}
SELECT source_key, code, setting, billing_class, count(*) AS n_rates, round(min(negotiated_dollar), 6) AS min_rate,
  round(quantile_cont(negotiated_dollar, 0.5), 6) AS median_rate, round(max(negotiated_dollar), 6) AS max_rate
FROM rates WHERE code IN ('SMALL', 'LARGE') AND {_USABLE} GROUP BY ALL""",
    "rate_type_counts": f"""WITH {RATES_CTE}
SELECT source_key, code, setting, billing_class, rate_type, count(*) AS n_rates
FROM rates WHERE code IN ('SMALL', 'LARGE') GROUP BY ALL""",
    "rate_type_counts_of_source": f"""WITH {RATES_CTE}
SELECT code, setting, billing_class, rate_type, count(*) AS n_rates
FROM rates WHERE code IN ('SMALL', 'LARGE') AND source_key = 'NATION_3' GROUP BY ALL""",
    "category_coverage": f"""WITH {STAGED_CTE}, {PAYERS_CTE}
SELECT payer_category, payer_category_is_default, count(*) AS n_payer_plans FROM payer_categories GROUP BY ALL""",
    "item_breakdown": f"""WITH {RATES_CTE}
SELECT item_description, item_codes, setting, count(*) AS n, round(min(negotiated_dollar), 6) AS min_rate,
  round(max(negotiated_dollar), 6) AS max_rate
FROM rates WHERE source_key = 'NATION_3' AND code = 'SMALL' AND rate_type = 'dollar' GROUP BY ALL""",
    "top_payer_plans": f"""WITH {RATES_CTE}
SELECT payer_name, plan_name, count(*) AS n FROM rates WHERE rate_type = 'dollar' GROUP BY ALL
ORDER BY n DESC, payer_name NULLS FIRST, plan_name NULLS FIRST LIMIT 100""",
    "lowest_payer_rates": f"""WITH {RATES_CTE}
SELECT hospital_name, payer_name, plan_name, round(min(negotiated_dollar), 6) AS min_rate,
  round(max(negotiated_dollar), 6) AS max_rate
FROM rates WHERE payer_category = 'commercial' AND code IN ('SMALL', 'LARGE') AND billing_class = 'f' AND {_USABLE}
GROUP BY ALL ORDER BY min(negotiated_dollar), hospital_name, payer_name, plan_name NULLS FIRST LIMIT 40""",
    "drill_down": f"""WITH {RATES_CTE}
SELECT item_description, item_codes, modifiers, setting, round(negotiated_dollar, 6) AS negotiated_dollar, methodology
FROM rates WHERE source_key = 'NATION_3' AND code = 'SMALL' AND rate_type = 'dollar' AND payer_name = 'HOUSEHOLD 4'
  AND plan_name LIKE 'plan%'""",
    "gold_look_up": f"""WITH {VARIATION_CTE}, {_ACROSS_VARIATION}
SELECT {_round(*_ACROSS)} FROM across WHERE code IN ('SMALL', 'LARGE') AND billing_class = 'f'""",
    "measure_ids": """SELECT DISTINCT CASE event_type WHEN 'view' THEN 'readm_30_hip_knee' ELSE 'COMP_HIP_KNEE' END
  AS measure_id FROM events WHERE event_type IN ('view', 'click')""",
    "reporting_hospitals": f"""WITH {OUTCOMES_CTE}, {CMS_CTE}
SELECT count(*) AS hospitals_with_readmission_rate
FROM outcomes o JOIN cms m ON o.hospital_ccn = m.hospital_ccn WHERE o.readmission_reported AND m.state = 'TN'""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS t, count(*) AS n FROM {t}"
        for t in ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")
    ),
}
