"""The expected results as DuckDB SQL over the same tables, written independently of the plans."""

from __future__ import annotations

from ratescope.workload.star import PROCEDURES, RULES


def _literal(v) -> str:
    if v is None:
        return "NULL"
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)


RULES_CTE = f"rules(priority, category, pattern, note) AS (VALUES {_values(RULES)})"
PROCEDURES_CTE = f"procedure_codes(code_type, code, procedure_label, description) AS (VALUES {_values(PROCEDURES)})"

LINES_CTE = """
lines AS (
  SELECT l.*, p.*, n.*, c.*
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)"""

KIND = (
    "CASE WHEN p_size % 7 = 0 THEN 'CDM' WHEN p_size % 5 = 0 THEN 'MS-DRG' WHEN p_size % 2 = 0 THEN 'CPT' "
    "ELSE 'HCPCS' END"
)

STAGED_CTE = f"""{LINES_CTE},
staged AS (
  SELECT DISTINCT
    n_name AS source_key, p_name AS item_description,
    array_to_string(list_sort(list_distinct([{KIND} || ':' || p_type, 'CDM:' || p_brand])), '|') AS item_codes,
    CASE WHEN l_linenumber > 5 THEN '52' END AS modifiers,
    p_type AS code, {KIND} AS code_type,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'KNEE' WHEN p_type = 'LARGE' THEN 'HIP' END AS procedure_label,
    lower(l_returnflag) AS setting,
    CASE WHEN l_linenumber < 7 THEN l_linestatus END AS billing_class_in_file,
    c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) AS payer_name,
    CASE WHEN c_custkey % 7 < 6 THEN 'plan ' || CAST(c_custkey % 7 AS VARCHAR) END AS plan_name,
    CASE WHEN l_quantity >= 5 THEN l_extendedprice END AS negotiated_dollar,
    CASE WHEN l_quantity >= 3 AND l_quantity < 5 THEN l_discount END AS negotiated_percentage,
    CASE WHEN l_quantity = 2 THEN 'per contract' END AS negotiated_algorithm,
    CASE WHEN l_linenumber % 3 = 0 THEN 'case rate' ELSE 'fee schedule' END AS methodology,
    l_extendedprice AS gross_charge, l_discount AS min_charge, l_tax AS max_charge
  FROM lines
)"""

HEADERS_CTE = """
header_text AS (
  SELECT n_name AS source_key, n_name AS hospital_name_in_file,
    CASE n_nationkey % 3
      WHEN 0 THEN '2025-10-0' || CAST(n_nationkey % 9 + 1 AS VARCHAR)
      WHEN 1 THEN '1/' || CAST(n_nationkey % 9 + 1 AS VARCHAR) || '/2026'
      ELSE 'soon' END AS last_updated_raw
  FROM nation
),
headers AS (
  SELECT source_key, last_updated_raw,
    CAST(coalesce(try_strptime(last_updated_raw, '%Y-%m-%d'), try_strptime(last_updated_raw, '%-m/%-d/%Y'))
      AS DATE) AS last_updated_on,
    hospital_name_in_file, CAST(NULL AS VARCHAR) AS file_version
  FROM header_text
)"""

CROSSWALK_CTE = """
crosswalk AS (
  SELECT n_name AS source_key, lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS hospital_ccn,
    'Hospital of ' || n_name AS hospital_name,
    CASE WHEN n_nationkey % 3 = 0 THEN 'facility' END AS assumed_billing_class
  FROM nation
)"""

#: What the rules look at. It is never NULL, so it serves as the key of a name in joins.
_RULE_TEXT = "trim(regexp_replace(lower(concat_ws(' ', payer_name, plan_name)), '[^a-z0-9]+', ' ', 'g'))"

PAYERS_CTE = f"""{RULES_CTE},
best_rules AS (
  SELECT rule_text, min({{'priority': priority, 'pattern': pattern, 'category': category}}) AS best
  FROM (SELECT DISTINCT {_RULE_TEXT} AS rule_text FROM staged) JOIN rules ON regexp_matches(rule_text, pattern)
  GROUP BY rule_text
),
payer_categories AS (
  SELECT DISTINCT payer_name, plan_name, coalesce(best.category, 'commercial') AS payer_category,
    best IS NULL AS payer_category_is_default, best.pattern AS matched_pattern
  FROM (SELECT payer_name, plan_name, {_RULE_TEXT} AS rule_text FROM staged) LEFT JOIN best_rules USING (rule_text)
)"""

RATES_FROM_STAGED_CTE = f"""
sources AS (
  SELECT crosswalk.*, last_updated_on AS file_last_updated_on FROM crosswalk LEFT JOIN headers USING (source_key)
),
rates AS (
  SELECT * EXCLUDE (rule_text, best, assumed_billing_class, billing_class_in_file),
    if(code_type IN ('CPT', 'HCPCS'), 'CPT/HCPCS', code_type) AS code_family,
    procedure_label IS NOT NULL AS is_featured,
    lower(coalesce(billing_class_in_file, assumed_billing_class)) AS billing_class,
    billing_class_in_file IS NULL AND assumed_billing_class IS NOT NULL AS billing_class_assumed,
    coalesce(best.category, 'commercial') AS payer_category, best IS NULL AS payer_category_is_default,
    coalesce(if(negotiated_dollar IS NULL, NULL, 'dollar'), if(negotiated_percentage IS NULL, NULL, 'percentage'),
      if(negotiated_algorithm IS NULL, 'none', 'algorithm')) AS rate_type,
    coalesce(negotiated_dollar < 5000, FALSE) AS is_placeholder_rate
  FROM (SELECT *, {_RULE_TEXT} AS rule_text FROM staged)
  LEFT JOIN best_rules USING (rule_text)
  JOIN sources USING (source_key)
)"""

RATES_CTE = f"""{STAGED_CTE},
{HEADERS_CTE},
{CROSSWALK_CTE},
{PAYERS_CTE},
{RATES_FROM_STAGED_CTE}"""

USABLE_CTE = """
usable AS (
  SELECT hospital_ccn, hospital_name, code_family, code, setting, coalesce(billing_class, 'unspecified') AS billing_class,
    billing_class_assumed, payer_category, payer_name, plan_name, modifiers, procedure_label, item_description,
    file_last_updated_on, rate_type, is_placeholder_rate,
    CASE WHEN rate_type = 'dollar' AND NOT is_placeholder_rate THEN negotiated_dollar END AS rate
  FROM rates WHERE code_type IN ('CPT', 'HCPCS', 'MS-DRG')
)"""


def _stats(keys: str, name: str) -> str:
    """Statistics as windows over the lines: of a payer/plan, then of a service over the first line of each payer/plan."""
    return f"""
{name}_lines AS (
  SELECT *, row_number() OVER of_plan = 1 AS leads,
    coalesce(quantile_cont(rate, 0.5) FILTER (WHERE modifiers IS NULL) OVER of_plan, quantile_cont(rate, 0.5) OVER of_plan)
      AS plan_rate
  FROM usable WINDOW of_plan AS (PARTITION BY {keys}, payer_name, plan_name)
),
{name}_measured AS (
  SELECT *, count(plan_rate) FILTER (WHERE leads) OVER of_service AS n_rates, count(rate) OVER of_service AS n_lines,
    count(DISTINCT payer_name) FILTER (WHERE plan_rate IS NOT NULL) OVER of_service AS n_payers,
    min(plan_rate) OVER of_service AS min_rate, max(plan_rate) OVER of_service AS max_rate,
    quantile_cont(plan_rate, [0.25, 0.5, 0.75]) FILTER (WHERE leads) OVER of_service AS points
  FROM {name}_lines WINDOW of_service AS (PARTITION BY {keys})
),
{name}_stats AS (
  SELECT hospital_name, {keys}, max(procedure_label) AS procedure_label, max(item_description) AS item_description,
    max(file_last_updated_on) AS file_last_updated_on, bool_or(billing_class_assumed) AS billing_class_assumed,
    countif(rate_type = 'percentage')::BIGINT AS n_percentage, countif(rate_type = 'algorithm')::BIGINT AS n_algorithm,
    countif(is_placeholder_rate)::BIGINT AS n_placeholder,
    n_rates, n_lines, n_payers, min_rate, points[1] AS p25_rate, points[2] AS median_rate, points[3] AS p75_rate, max_rate
  FROM {name}_measured GROUP BY ALL
)"""


BY_CATEGORY_FROM_RATES_CTE = f"""{USABLE_CTE},
{_stats("hospital_ccn, code_family, code, setting, billing_class, payer_category", "cat")},
by_category AS (
  SELECT hospital_ccn, hospital_name, code_family, code, setting, billing_class, payer_category, procedure_label,
    item_description, file_last_updated_on, n_rates AS n_payer_plans, min_rate, p25_rate, median_rate, p75_rate, max_rate,
    n_percentage AS n_percentage_lines, n_algorithm AS n_algorithm_lines, n_placeholder AS n_placeholder_lines
  FROM cat_stats
)"""

BY_CATEGORY_CTE = f"""{RATES_CTE},
{BY_CATEGORY_FROM_RATES_CTE}"""

OUTCOMES_CTE = """
measures AS (
  SELECT lpad(CAST(user_id % 30 AS VARCHAR), 6, '0') AS hospital_ccn, event_type,
    CASE WHEN event_id % 11 = 0 THEN 'Not Available' ELSE ' ' || CAST(event_id % 997 AS VARCHAR) || ' ' END AS score,
    CAST(event_id % 50 AS VARCHAR) AS lo, CAST(event_id % 60 AS VARCHAR) AS hi,
    json_extract_string(props, '$.k') AS denominator, strftime(ts, '%m/%d/%Y') AS end_date
  FROM events
),
readmission AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY hospital_ccn ORDER BY end_date DESC, score DESC, lo DESC, hi DESC,
      denominator DESC) AS rn
    FROM measures WHERE event_type = 'view') t WHERE rn = 1
),
complication AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY hospital_ccn ORDER BY end_date DESC, score DESC) AS rn
    FROM measures WHERE event_type = 'click') t WHERE rn = 1
),
outcomes AS (
  SELECT r.hospital_ccn, try_cast(trim(r.score) AS DOUBLE) AS readmission_rate,
    CAST(r.lo AS DOUBLE) AS readmission_lower, CAST(r.hi AS DOUBLE) AS readmission_upper,
    CAST(r.denominator AS DOUBLE) AS readmission_denominator,
    'view' AS readmission_vs_national, CAST(NULL AS VARCHAR) AS readmission_footnote,
    CAST(NULL AS VARCHAR) AS readmission_start_date, r.end_date AS readmission_end_date,
    try_cast(trim(r.score) AS DOUBLE) IS NOT NULL AS readmission_reported,
    try_cast(trim(c.score) AS DOUBLE) AS complication_rate,
    CASE WHEN c.hospital_ccn IS NOT NULL THEN 'click' END AS complication_vs_national
  FROM readmission r LEFT JOIN complication c ON r.hospital_ccn = c.hospital_ccn
)"""

CMS_CTE = """
cms AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS hospital_ccn, s_name AS hospital_name,
    CAST(NULL AS VARCHAR) AS city, n_name AS county, CASE WHEN n_regionkey = 1 THEN 'TN' ELSE 'KY' END AS state,
    CAST(NULL AS VARCHAR) AS zip_code,
    CASE WHEN s_acctbal < 0 THEN 'Critical Access' ELSE 'Acute Care' END AS hospital_type,
    CAST(NULL AS VARCHAR) AS hospital_ownership
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

HOSPITALS_CTE = """
hospitals AS (
  SELECT x.hospital_ccn, x.hospital_name, x.source_key, m.hospital_name AS cms_hospital_name, m.city, m.county, m.state,
    m.zip_code, m.hospital_type, m.hospital_ownership, m.hospital_ccn IS NOT NULL AS in_cms_general_info,
    coalesce(o.readmission_reported, FALSE) AS has_cms_readmission_data,
    o.complication_rate IS NOT NULL AS has_cms_complication_data,
    h.last_updated_on AS price_file_last_updated_on, h.hospital_name_in_file, h.file_version AS price_file_version
  FROM crosswalk x
  LEFT JOIN cms m ON x.hospital_ccn = m.hospital_ccn
  LEFT JOIN outcomes o ON x.hospital_ccn = o.hospital_ccn
  LEFT JOIN headers h ON x.source_key = h.source_key
)"""

VARIATION_CTE = f"""{RATES_CTE},
{USABLE_CTE},
{_stats("hospital_ccn, code_family, code, setting, billing_class", "var")},
{OUTCOMES_CTE},
{CMS_CTE},
{HOSPITALS_CTE},
variation AS (
  SELECT v.hospital_ccn, v.hospital_name, v.code_family, v.code, v.setting, v.billing_class, v.billing_class_assumed,
    v.procedure_label, v.item_description, v.file_last_updated_on, v.n_rates AS n_dollar_rates,
    v.n_lines AS n_dollar_lines, v.n_payers, v.min_rate, v.p25_rate, v.median_rate, v.p75_rate, v.max_rate,
    v.max_rate / nullif(v.min_rate, 0) AS spread_ratio, v.n_percentage AS n_percentage_rates,
    v.n_algorithm AS n_algorithm_rates, v.n_placeholder AS n_placeholder_rates,
    h.county, h.hospital_type, h.hospital_ownership
  FROM var_stats v LEFT JOIN hospitals h ON v.hospital_ccn = h.hospital_ccn
)"""
