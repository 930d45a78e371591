"""DuckDB statements for the file, load-log, reshape and quality queries."""

from __future__ import annotations

from ratescope.workload.expected import EXPECTED
from ratescope.workload.oracle import (
    BY_CATEGORY_FROM_RATES_CTE,
    KIND,
    LINES_CTE,
    PAYERS_CTE,
    PROCEDURES_CTE,
    RATES_CTE,
    RATES_FROM_STAGED_CTE,
    VARIATION_CTE,
)

_TYPES = "('CPT', 'HCPCS', 'MS-DRG')"
_NULL_DOUBLE = "CAST(NULL AS DOUBLE)"
_PLAN = "'plan ' || CAST(c_custkey % 7 AS VARCHAR)"

# Slot rows of a line: place, code, type. Blank slots are left out.
_SLOT_ROWS = f"""
slot_rows AS (
  SELECT *, p_type AS code, {KIND} AS code_type, 1 AS slot FROM lines
  UNION ALL SELECT *, p_brand, 'CDM', 2 FROM lines
  UNION ALL SELECT *, p_type, 'HCPCS', 4 FROM lines WHERE p_size % 4 = 0
)"""

_CODES_4 = (
    f"array_to_string(list_sort(list_distinct([{KIND} || ':' || p_type, 'CDM:' || p_brand] || "
    "CASE WHEN p_size % 4 = 0 THEN ['HCPCS:' || p_type] ELSE [] END)), '|')"
)
_CODES_2 = f"array_to_string(list_sort([{KIND} || ':' || p_type, 'CDM:' || p_brand]), '|')"


def _labelled(condition: str, featured: bool) -> str:
    join = "JOIN" if featured else "LEFT JOIN"
    keep = " AND pc.procedure_label IS NOT NULL" if featured else ""
    return f"""
labelled AS (
  SELECT s.*, pc.procedure_label FROM slot_rows s
  {join} procedure_codes pc ON s.code = pc.code AND s.code_type = upper(pc.code_type)
  WHERE s.code_type IN {_TYPES} AND {condition}{keep}
)"""


def _csv_rates(
    source: str, description: str, codes: str, billing: str, payer: str, plan: str, methodology: str
) -> str:
    return f"""SELECT '{source}' AS source_key, {description} AS item_description, {codes} AS item_codes,
  CASE WHEN l_linenumber > 5 THEN '52' END AS modifiers, code, code_type, procedure_label, l_returnflag AS setting,
  {billing} AS billing_class, {payer} AS payer_name, {plan} AS plan_name,
  CASE WHEN l_quantity >= 5 THEN round(l_extendedprice, 6) END AS negotiated_dollar,
  CASE WHEN l_quantity = 3 THEN round(l_discount, 6) END AS negotiated_percentage,
  CASE WHEN l_quantity = 2 THEN 'per contract' END AS negotiated_algorithm, {_NULL_DOUBLE} AS estimated_amount,
  {methodology} AS methodology, round(l_extendedprice, 6) AS gross_charge,
  CASE WHEN l_tax > 0.01 THEN round(l_tax, 6) END AS min_charge, l_quantity AS max_charge, 'run-1' AS _run_id
FROM labelled"""


_ODD_DESCRIPTION = (
    "CASE WHEN p_size % 10 = 0 THEN p_name || ', \"large\"' || chr(10) || 'size ' || CAST(p_size AS VARCHAR) "
    "ELSE p_name END"
)


_JSON_CHARGES = """
charges AS (
  SELECT *, l_returnflag AS setting, l_linestatus AS billing_class, round(l_extendedprice, 6) AS gross_charge,
    round(l_tax, 6) AS min_charge FROM lines
  UNION ALL
  SELECT *, 'no payers', NULL, NULL, NULL FROM lines WHERE l_linenumber = 1
)"""


def _json_rates(featured: bool) -> str:
    join = "JOIN" if featured else "LEFT JOIN"
    mentioned = " AND l.p_type IN ('SMALL', 'LARGE', 'PROMO') AND pc.procedure_label IS NOT NULL" if featured else ""
    return f"""SELECT 'json' AS source_key, p_name AS item_description, {_CODES_2} AS item_codes,
  CAST(NULL AS VARCHAR) AS modifiers,
  p_type AS code, {KIND} AS code_type, pc.procedure_label, setting, billing_class, c_mktsegment AS payer_name,
  {_PLAN} AS plan_name, CASE WHEN l_quantity >= 5 THEN round(l_extendedprice, 6) END AS negotiated_dollar,
  CASE WHEN l_quantity = 3 THEN round(l_discount, 6) END AS negotiated_percentage,
  CASE WHEN l_quantity = 2 THEN 'per contract' END AS negotiated_algorithm,
  CASE WHEN l_quantity = 2 THEN round(l_tax, 6) END AS estimated_amount, 'fee schedule' AS methodology,
  gross_charge, min_charge, {_NULL_DOUBLE} AS max_charge, 'run-1' AS _run_id
FROM charges l {join} procedure_codes pc ON l.p_type = pc.code AND {KIND} = upper(pc.code_type)
WHERE l.p_size % 11 > 0 AND {KIND} IN {_TYPES}{mentioned}"""


_TALL = _csv_rates("tall", _ODD_DESCRIPTION, _CODES_4, "l_linestatus", "c_mktsegment", _PLAN, "'fee schedule'")
_WIDE = _csv_rates(
    "wide", "p_name", _CODES_4, "l_linestatus", "c_mktsegment || '''s'",
    "CASE WHEN c_custkey % 7 = 6 THEN 'plan|6' ELSE 'plan ' || CAST(c_custkey % 7 AS VARCHAR) END",
    "CASE WHEN c_mktsegment <> 'BUILDING' THEN 'case rate' END",
)
_JSON_WITH = f"WITH {LINES_CTE}, {PROCEDURES_CTE}, {_JSON_CHARGES} "

# The nation in whose name a price file is stated, and the day of October it states.
_STATING = """stating AS (
  SELECT n_name, n_nationkey % 9 + 1 AS stated_day
  FROM nation JOIN (SELECT unnest(range(count(*) // 20000 + 2)) AS file FROM lineitem) ON file % 25 = n_nationkey
)"""

# The three layouts as one rates table: one hospital per layout.
_FROM_FILES = f"""WITH {LINES_CTE}, {PROCEDURES_CTE}, {_SLOT_ROWS}, {_labelled('l_quantity >= 2', False)}, {_JSON_CHARGES},
tall AS ({_TALL}),
wide AS ({_WIDE}),
nested AS ({_json_rates(False)}),
staged AS (
  SELECT DISTINCT * REPLACE (lower(setting) AS setting) RENAME (billing_class AS billing_class_in_file)
  FROM (SELECT * FROM tall UNION ALL BY NAME SELECT * FROM wide UNION ALL BY NAME SELECT * FROM nested)
),
{_STATING},
headers AS (
  SELECT unnest(['tall', 'wide', 'json']) AS source_key, make_date(2025, 10, max(stated_day)) AS last_updated_on FROM stating
),
crosswalk AS (
  SELECT * FROM (VALUES ('tall', '000001', 'Tall', 'facility'), ('wide', '000002', 'Wide', NULL), ('json', '000003', 'Json', NULL))
    t(source_key, hospital_ccn, hospital_name, assumed_billing_class)
),
{PAYERS_CTE},
{RATES_FROM_STAGED_CTE},
{BY_CATEGORY_FROM_RATES_CTE}
SELECT * REPLACE (round(min_rate, 6) AS min_rate, round(p25_rate, 6) AS p25_rate, round(median_rate, 6) AS median_rate,
  round(p75_rate, 6) AS p75_rate, round(max_rate, 6) AS max_rate) FROM by_category"""

_LOG_CTE = """
log AS (
  SELECT event_id, 'run-' || CAST(event_id // 200 AS VARCHAR) AS run_id, 'key-' || CAST(user_id AS VARCHAR) AS dataset_key,
    CASE WHEN user_id % 2 = 0 THEN 'hospital_price_file' ELSE 'provider_data_catalog' END AS source,
    CASE WHEN user_id % 2 = 1 AND event_type IN ('view', 'purchase') THEN CAST(event_id % 5 AS INTEGER) END AS page_number,
    CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS row_count,
    CASE event_type WHEN 'view' THEN 'succeeded' WHEN 'purchase' THEN 'succeeded' WHEN 'signup' THEN 'started'
      WHEN 'error' THEN 'failed' ELSE 'skipped' END AS status,
    CASE WHEN event_type = 'error' THEN 'timed out' END AS error_message,
    '/landing/run_id=r' || CAST(event_id AS VARCHAR) || '/f.csv' AS landing_path, ts AS event_ts,
    CASE WHEN event_type <> 'view' THEN event_id * 10 END AS file_bytes,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0
      THEN 'e' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR) END AS etag,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 1
      THEN 'Wed, 10 Jan 2024 10:00:00 GMT' END AS last_modified
  FROM events
)"""

_DOWNLOADS_CTE = f"""{_LOG_CTE},
downloads AS (
  SELECT dataset_key, landing_path, file_bytes, etag, last_modified, event_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY event_ts DESC) AS rn
    FROM log WHERE source = 'hospital_price_file' AND status = 'succeeded') t WHERE rn = 1
)"""

_REFRESH = f"""WITH {_DOWNLOADS_CTE},
observed AS (
  SELECT k.dataset_key, k.n % 40 = 0 AS forced, CASE WHEN k.n % 14 > 0 THEN coalesce(d.file_bytes, 7) END AS disk_bytes,
    k.n % 18 > 0 AS headers_read, CASE WHEN k.n % 4 = 0 THEN 'e0' END AS etag,
    CASE k.n % 6 WHEN 0 THEN 'Wed, 10 Jan 2024 10:00:00 GMT' WHEN 2 THEN 'Mon, 01 Jan 2024 10:00:00 GMT' END AS lm,
    CASE k.n % 6 WHEN 0 THEN TIMESTAMP '2024-01-10 10:00:00' WHEN 2 THEN TIMESTAMP '2024-01-01 10:00:00' END AS lm_ts,
    CASE WHEN k.n % 10 = 0 THEN '12x' END AS content_length,
    d.dataset_key IS NOT NULL AS has_prev, d.landing_path, d.file_bytes, d.etag AS p_etag, d.last_modified AS p_lm,
    d.event_ts
  FROM (SELECT DISTINCT dataset_key, CAST(substr(dataset_key, 5) AS INTEGER) AS n FROM log
        WHERE source = 'hospital_price_file') k
  LEFT JOIN downloads d ON k.dataset_key = d.dataset_key
),
reasons AS (
  SELECT dataset_key, CASE
    WHEN forced THEN 'force_download is on'
    WHEN NOT has_prev THEN 'no earlier successful download'
    WHEN disk_bytes IS DISTINCT FROM file_bytes OR disk_bytes IS NULL
      THEN 'earlier file is missing or its size changed on disk'
    WHEN TIMESTAMP '2024-02-27 00:00:00' - event_ts > INTERVAL 30 DAY
      THEN 'earlier download is over 30 days old; refreshing'
    WHEN NOT headers_read THEN 'could not read headers from the server'
    WHEN etag IS NOT NULL AND p_etag IS NOT NULL
      THEN CASE WHEN etag = p_etag THEN 'ETag unchanged' ELSE 'ETag changed' END
    WHEN lm IS NOT NULL AND p_lm IS NOT NULL
      THEN CASE WHEN lm = p_lm THEN 'Last-Modified unchanged' ELSE 'Last-Modified changed' END
    WHEN lm_ts IS NOT NULL THEN CASE WHEN lm_ts <= event_ts AND content_length IS NULL
      THEN 'not modified since the last download' ELSE 'modified after the last download, or the size differs' END
    ELSE 'server gave no reliable change signal' END AS reason
  FROM observed
)
SELECT dataset_key, reason IN ('ETag unchanged', 'Last-Modified unchanged', 'not modified since the last download') AS skip,
  reason FROM reasons"""

_CONTIGUITY = f"""WITH {_LOG_CTE},
per_key AS (
  SELECT dataset_key, count(*) FILTER (WHERE status = 'started') AS n_started,
    count(*) FILTER (WHERE status = 'failed') AS n_failed,
    count(*) FILTER (WHERE page_number IS NOT NULL) AS n_pages,
    max(page_number) FILTER (WHERE page_number IS NOT NULL) - min(page_number) FILTER (WHERE page_number IS NOT NULL) + 1
      AS span,
    count(DISTINCT page_number) AS n_numbers
  FROM log GROUP BY dataset_key
),
checks AS (
  SELECT dataset_key AS subject, 'started_logged' AS check_name, CASE WHEN n_started > 0 THEN 0 ELSE 1 END AS n_bad
  FROM per_key
  UNION ALL SELECT dataset_key, 'no_failed_events', n_failed FROM per_key
  UNION ALL SELECT dataset_key, 'pages_landed', CASE WHEN n_pages > 0 THEN 0 ELSE 1 END FROM per_key
  UNION ALL SELECT dataset_key, 'pages_contiguous', greatest(abs(span - n_pages), n_pages - n_numbers) FROM per_key
    WHERE n_pages > 0
  UNION ALL SELECT dataset_key, 'files_exist', n_pages FROM per_key WHERE n_pages > 0
  UNION ALL SELECT dataset_key, 'no_stale_files', 0 FROM per_key WHERE n_pages > 0
)
SELECT subject, check_name, CASE WHEN n_bad > 0 THEN 'fail' ELSE 'pass' END AS status, CAST(n_bad AS BIGINT) AS n_bad
FROM checks"""

_RATE_KEYS = "source_key, code_type, code, setting, billing_class, modifiers, payer_name, plan_name"

_REPORT = f"""WITH {VARIATION_CTE},
bad AS (
  SELECT 'rates' AS subject, 'not_null code' AS check_name, 'fail' AS severity,
    (SELECT count(*) FROM rates WHERE code IS NULL) AS n_bad
  UNION ALL SELECT 'rates', 'not_null file_last_updated_on', 'fail',
    (SELECT count(*) FROM rates WHERE file_last_updated_on IS NULL)
  UNION ALL SELECT 'rates', 'no_negative_dollar_rates', 'fail', (SELECT count(*) FROM rates WHERE negotiated_dollar < 0)
  UNION ALL SELECT 'variation', 'min_not_above_max', 'fail',
    (SELECT count(*) FROM variation WHERE n_dollar_rates > 0 AND (min_rate > median_rate OR median_rate > max_rate))
  UNION ALL SELECT 'rates', 'relationships hospital_ccn', 'fail',
    (SELECT count(DISTINCT hospital_ccn) FROM rates WHERE hospital_ccn NOT IN (SELECT hospital_ccn FROM hospitals))
  UNION ALL SELECT 'rates', 'unique_combination', 'warn', (SELECT count(*) FROM (
    SELECT 1 FROM rates GROUP BY source_key, code, payer_name, plan_name HAVING count(*) > 1))
)
SELECT subject, check_name, CASE WHEN n_bad = 0 THEN 'pass' ELSE severity END AS status, n_bad,
  CAST(n_bad AS VARCHAR) || ' bad row(s)' AS detail FROM bad"""

_SNIFF = """
WITH heads AS (
  SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '[1] ' || url WHEN page_id % 5 = 0 THEN html WHEN page_id % 11 = 0 THEN ''
    WHEN page_id % 13 = 0 THEN 'PK' || url ELSE html END AS bare,
    page_id % 7 > 0 AND page_id % 5 > 0 AND page_id % 11 > 0 AND page_id % 13 = 0 AS zipped
  FROM pages
),
parts AS (SELECT *, lower(ltrim(bare)) AS start FROM heads)
SELECT page_id, CASE
  WHEN bare = '' THEN 'empty response body'
  WHEN page_id % 3 < 2 AND (start LIKE '<!doctype%' OR start LIKE '<html%')
    THEN 'received an HTML page instead of a data file'
  WHEN page_id % 3 = 1 AND NOT (start LIKE '{%' OR start LIKE '[%')
    THEN 'expected JSON but payload does not start with { or ['
  WHEN page_id % 3 = 2 AND NOT zipped THEN 'expected a zip archive but the file signature is missing' END AS problem
FROM parts"""

_FILES = """
WITH f AS (SELECT DISTINCT c_custkey // 100 AS k, (c_custkey // 100) % 7 AS r FROM customer),
checks AS (
  SELECT k, 'started_logged' AS check_name, r <> 5 AS good, 'fail' AS severity FROM f
  UNION ALL SELECT k, 'no_failed_events', r <> 5, 'fail' FROM f
  UNION ALL SELECT k, 'one_succeeded_row', false, 'fail' FROM f WHERE r = 4
  UNION ALL SELECT k, 'download_or_skip', true, 'fail' FROM f WHERE k % 14 = 7
  UNION ALL SELECT k, 'file_exists', r <> 3, 'fail' FROM f WHERE r <> 4
  UNION ALL SELECT k, 'size_matches_manifest', r <> 1, 'fail' FROM f WHERE r NOT IN (3, 4)
  UNION ALL SELECT k, 'min_bytes', r <> 6, 'fail' FROM f WHERE r NOT IN (3, 4)
  UNION ALL SELECT k, 'checksum_matches', r <> 2, 'fail' FROM f WHERE r NOT IN (3, 4)
  UNION ALL SELECT k, 'format_looks_right', true, 'warn' FROM f WHERE r NOT IN (3, 4)
  UNION ALL SELECT k, 'hospital_name_in_file', r <> 6, 'warn' FROM f WHERE r NOT IN (3, 4)
)
SELECT 'f' || CAST(k AS VARCHAR) AS subject, check_name, CASE WHEN good THEN 'pass' ELSE severity END AS status,
  CAST(CASE WHEN good THEN 0 ELSE 1 END AS BIGINT) AS n_bad FROM checks"""

_PAGES = """
WITH p AS (SELECT c_custkey // 500 AS page, count(*) AS n FROM customer GROUP BY ALL),
a AS (SELECT count(*) AS pages, sum(n) AS n, max(page) - min(page) + 1 AS span, count(*) FILTER (page % 2 = 0) AS failed,
  count(*) FILTER (page % 3 = 1) AS off FROM p),
b AS (SELECT count(*) AS pages, (max(page) - min(page)) * 2 + 1 AS span, count(*) FILTER (page % 4 = 1) AS gone FROM p WHERE page % 3 <> 2),
found(subject, check_name, severity, n_bad) AS (
  SELECT 'a', 'started_logged', 'fail', 1 FROM a
  UNION ALL SELECT 'a', 'no_failed_events', 'fail', failed FROM a
  UNION ALL SELECT 'a', 'pages_landed', 'fail', 0 FROM a
  UNION ALL SELECT 'a', 'pages_contiguous', 'fail', abs(span - pages) FROM a
  UNION ALL SELECT 'a', 'files_exist', 'fail', 0 FROM a
  UNION ALL SELECT 'a', 'no_stale_files', 'warn', 0 FROM a
  UNION ALL SELECT 'a', 'pages_parse', 'fail', 0 FROM a
  UNION ALL SELECT 'a', 'rows_reconcile', 'fail', 2 * off FROM a
  UNION ALL SELECT 'a', 'min_rows', 'fail', greatest(1000000 - n, 0) FROM a
  UNION ALL SELECT 'a', 'required_columns', 'fail', 1 FROM a
  UNION ALL SELECT 'b', 'started_logged', 'fail', 0 FROM b
  UNION ALL SELECT 'b', 'no_failed_events', 'fail', 0 FROM b
  UNION ALL SELECT 'b', 'pages_landed', 'fail', 0 FROM b
  UNION ALL SELECT 'b', 'pages_contiguous', 'fail', abs(span - pages) FROM b
  UNION ALL SELECT 'b', 'files_exist', 'fail', gone FROM b
  UNION ALL SELECT 'b', 'no_stale_files', 'warn', gone FROM b
  UNION ALL SELECT 'b', t.name, 'fail', 0 FROM b, (VALUES ('pages_parse'), ('rows_reconcile'), ('min_rows')) t(name) WHERE gone = 0
)
SELECT subject, check_name, CASE WHEN n_bad = 0 THEN 'pass' ELSE severity END AS status, CAST(n_bad AS BIGINT) AS n_bad FROM found"""

_TABLE_CHECKS = """
WITH found(subject, check_name, severity, n_bad) AS (
  SELECT 'orders', 'not_null o_custkey', 'fail', count(*) FROM orders WHERE o_custkey IS NULL
  UNION ALL SELECT 'orders', 'not_null o_orderstatus', 'fail', count(*) FROM orders WHERE o_orderstatus IS NULL
  UNION ALL SELECT 'orders', 'unique o_orderkey', 'fail', count(*) FROM (SELECT 1 FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'unique o_custkey', 'fail', count(*) FROM (SELECT 1 FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'accepted_values o_orderpriority', 'fail', count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
  UNION ALL SELECT 'orders', 'accepted_values o_orderstatus', 'fail', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'orders', 'unique_combination', 'warn', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'unique_combination', 'fail', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey, o_orderstatus HAVING count(*) > 1)
  UNION ALL SELECT 'orders', 'relationships o_custkey', 'fail', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'events', 'accepted_values event_type', 'fail', count(DISTINCT event_type) FROM events WHERE event_type NOT IN ('view', 'click', 'signup')
  UNION ALL SELECT 'events', 'unique user_id', 'fail', count(*) FROM (SELECT 1 FROM events WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)
  UNION ALL SELECT 'events', 'relationships user_id', 'warn', count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT 'documents', 'unique doc_id', 'fail', count(*) FROM (SELECT 1 FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)
  UNION ALL SELECT 'documents', 'relationships doc_id', 'fail', count(DISTINCT doc_id) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
)
SELECT subject, check_name, CASE WHEN n_bad = 0 THEN 'pass' ELSE severity END AS status, n_bad,
  CAST(n_bad AS VARCHAR) || ' bad row(s)' AS detail FROM found"""

EXPECTED.update({
    "tall_csv_rates": f"WITH {LINES_CTE}, {PROCEDURES_CTE}, {_SLOT_ROWS}, {_labelled('l_quantity >= 2', False)} {_TALL}",
    "tall_csv_featured_rates": f"WITH {LINES_CTE}, {PROCEDURES_CTE}, {_SLOT_ROWS}, "
    f"{_labelled('l_quantity >= 2 AND slot <= 2', True)} "
    + _csv_rates("tall", "p_name", _CODES_2, "CAST(NULL AS VARCHAR)", "c_mktsegment", _PLAN, "'fee schedule'"),
    "wide_csv_rates": f"WITH {LINES_CTE}, {PROCEDURES_CTE}, {_SLOT_ROWS}, {_labelled('l_quantity >= 2', False)} {_WIDE}",
    "json_rates": _JSON_WITH + _json_rates(False),
    "json_featured_rates": _JSON_WITH + _json_rates(True),
    "rates_from_files": _FROM_FILES,
    "bronze_load": """SELECT c_custkey, c_name AS facility_name, round(c_acctbal, 6) AS c_acctbal, 'run-b' AS run_id,
  TRUE AS has_lineage FROM customer""",
    "price_csv_records": """SELECT 'rows' AS kind, count(*) AS n FROM lineitem
UNION ALL SELECT 'records', count(*) FROM lineitem""",
    "price_json_items_by_range": """
WITH items AS (SELECT CASE WHEN p_size % 11 > 0 THEN p_type END AS code FROM lineitem JOIN part ON l_partkey = p_partkey),
documents AS (SELECT count(*) // 20000 + 2 AS n FROM lineitem)
SELECT code, count(*) AS n_items FROM items WHERE code IS NOT NULL GROUP BY code
UNION ALL SELECT NULL, (SELECT count(*) FROM items WHERE code IS NULL) + n FROM documents
UNION ALL SELECT 'all items', (SELECT count(*) FROM items) + n FROM documents""",
    "load_shortfall": """SELECT 'run-1' AS run_id, l_returnflag AS setting, count(*) AS n_rows,
  ' has ' || (SELECT count(*) FROM lineitem WHERE l_returnflag <> 'R') || ' rows where its source states '
  || (SELECT count(*) FROM lineitem) AS refusal FROM lineitem GROUP BY l_returnflag""",
    "csv_and_json_headers": f"""WITH {_STATING}, stated AS (
  SELECT [(0, 'hospital_name', 'General, "Old" Hospital of ' || n_name), (1, 'last_updated_on', '2025-10-0' || stated_day),
    (2, 'version', '2.0.0'), (4, 'license_number|TN', ''), (0, 'hospital_name', 'General Hospital of ' || n_name),
    (1, 'last_updated_on', '10/' || stated_day || '/2025'), (2, 'affirmation', '{{"ok": true}}')] AS facts FROM stating
)
SELECT DISTINCT fact[1] AS position, fact[2] AS header_name, fact[3] AS header_value FROM (SELECT unnest(facts) AS fact FROM stated)""",
    "paged_json_latest_run": """SELECT c_custkey, c_name AS facility_name, round(c_acctbal, 6) AS c_acctbal,
  c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS zip_code FROM customer""",
    "paged_json_by_run_date": """SELECT c_custkey, c_name, CASE WHEN c_nationkey > 12 THEN round(c_acctbal, 6) END AS balance,
  '2025-01-0' || CAST(c_custkey % 5 + 1 AS VARCHAR) AS run_date FROM customer WHERE c_custkey % 5 + 1 >= 3""",
    "paged_json_fields": """SELECT '2025-01-0' || CAST(c_custkey % 5 + 1 AS VARCHAR) AS run_date, count(*) AS n_rows,
  count(*) FILTER (c_nationkey > 12) AS n_balances, count(DISTINCT c_custkey // 500) AS n_pages FROM customer GROUP BY c_custkey % 5""",
    "seed_file": """SELECT p_partkey, p_name || ', "' || p_brand || '"' AS name, p_size, round(p_retailprice, 6) AS p_retailprice FROM part""",
    "code_slot_unpivot": """
WITH slots AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderpriority AS code, 'PRIORITY' AS code_type FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderstatus, 'STATUS' FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderpriority, 'PRIORITY' FROM orders
)
SELECT o_orderkey, code, code_type, 'PRIORITY:' || o_orderpriority
  || CASE WHEN o_orderstatus <> 'P' THEN '|STATUS:' || o_orderstatus ELSE '' END AS item_codes FROM slots""",
    "wide_unpivot": f"""SELECT l_orderkey, l_linenumber, 'A / B' AS payer_name, 'P|1' AS plan_name,
  round(l_extendedprice, 6) AS dollar, round(l_discount, 6) AS percentage, CAST(NULL AS VARCHAR) AS algorithm,
  l_returnflag AS methodology FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'C''s', 'Q', round(l_tax, 6), {_NULL_DOUBLE}, l_linestatus, NULL
FROM lineitem""",
    "nested_item_explode": """SELECT conv_id, text, 'ROLE:' || role AS codes, CAST(turn AS VARCHAR) AS turn,
  CAST(length(text) AS DOUBLE) AS n_chars FROM conversations""",
    "header_pivot": """SELECT CAST(o_custkey AS VARCHAR) AS source_key,
  max(o_orderstatus) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
  max(o_orderstatus) FILTER (WHERE o_orderpriority = '5-LOW') AS low FROM orders GROUP BY o_custkey""",
    "label_and_scope": f"""WITH {PROCEDURES_CTE}, coded AS (SELECT p_partkey, p_type AS code, CASE WHEN p_size % 7 = 0
  THEN 'CDM' WHEN p_size % 5 = 0 THEN 'MS-DRG' WHEN p_size % 2 = 0 THEN 'cpt' ELSE 'HCPCS' END AS code_type FROM part)
SELECT c.p_partkey, c.code, c.code_type, pc.procedure_label FROM coded c
LEFT JOIN procedure_codes pc ON c.code = pc.code AND upper(c.code_type) = upper(pc.code_type)""",
    "label_and_scope_featured": f"""WITH {PROCEDURES_CTE}, coded AS (SELECT p_partkey, p_type AS code, CASE
  WHEN p_size % 7 = 0 THEN 'CDM' WHEN p_size % 5 = 0 THEN 'MS-DRG' WHEN p_size % 2 = 0 THEN 'cpt' ELSE 'HCPCS' END
  AS code_type FROM part)
SELECT c.p_partkey, c.code, c.code_type, pc.procedure_label FROM coded c
JOIN procedure_codes pc ON c.code = pc.code AND upper(c.code_type) = upper(pc.code_type)
WHERE pc.procedure_label IS NOT NULL AND upper(c.code_type) IN {_TYPES}""",
    "mentioned_codes": """SELECT page_id FROM pages
WHERE contains(html, '"fr"') OR contains(html, '"de"')""",
    "mentioned_codes_by_join": """SELECT c_custkey FROM customer
WHERE EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_' || CAST(c_nationkey * 2 AS VARCHAR))""",
    "staged_union_distinct": """SELECT l_returnflag, l_linestatus, round(l_quantity, 6) AS l_quantity,
  round(l_discount, 6) AS l_discount FROM (
  SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem
  UNION SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem)""",
    "payer_rules_by_join": """
WITH rules(priority, category, pattern) AS (VALUES (2, 'b', '^(red|blue) '), (1, 'a', 'blue b|gear'),
  (3, 'c', 'brand 1'), (1, 'z', 'bolt')),
named AS (
  SELECT *, trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', ' ', 'g')) AS match_text FROM part
),
hits AS (
  SELECT n.p_partkey, r.category, r.pattern, row_number() OVER (PARTITION BY n.p_partkey ORDER BY r.priority, r.pattern) AS rn
  FROM named n JOIN rules r ON regexp_matches(n.match_text, r.pattern)
)
SELECT n.p_partkey, n.p_name, n.p_brand, coalesce(h.category, 'commercial') AS payer_category,
  h.category IS NULL AS payer_category_is_default, h.pattern AS matched_pattern
FROM named n LEFT JOIN hits h ON n.p_partkey = h.p_partkey AND h.rn = 1""",
    "safe_casts": """SELECT l_orderkey, l_linenumber, l_linenumber = 1 AS blank,
  CASE WHEN l_linenumber IN (1, 2, 3) THEN NULL WHEN l_linenumber = 4 THEN 1000 WHEN l_linenumber = 5 THEN -5
    ELSE round(l_quantity, 6) END AS number, round(l_tax / nullif(l_discount, 0), 6) AS ratio FROM lineitem""",
    "file_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END AS file_date
FROM orders""",
    "name_overlap": """SELECT p_partkey, p_name LIKE '%large%' OR p_name LIKE '%widget%' AS same_name,
  CAST(len(list_distinct(regexp_extract_all(p_name, '[a-z]{4,}'))) AS INTEGER) AS n_tokens FROM part""",
    "run_ids": """SELECT CAST(event_id AS INTEGER) AS event_id,
  CASE WHEN event_id % 3 > 0 THEN 'r' || CAST(event_id AS VARCHAR) ELSE 'unknown' END AS run_id FROM events""",
    "last_downloads": f"WITH {_DOWNLOADS_CTE} SELECT * FROM downloads",
    "latest_run_pages": f"""WITH {_LOG_CTE},
landed AS (SELECT * FROM log WHERE status = 'succeeded' AND page_number IS NOT NULL),
newest AS (
  SELECT dataset_key, run_id FROM (SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY event_ts DESC) AS rn
  FROM landed) t WHERE rn = 1
)
SELECT l.dataset_key, l.run_id, count(*) AS n_pages, CAST(sum(coalesce(l.row_count, 0)) AS BIGINT) AS expected_rows
FROM landed l JOIN newest n ON l.dataset_key = n.dataset_key AND l.run_id = n.run_id GROUP BY ALL""",
    "run_summary": f"""WITH {_LOG_CTE} SELECT run_id, dataset_key, source, status, count(*) AS events,
  CAST(sum(coalesce(row_count, 0)) AS BIGINT) AS total_rows, CAST(sum(coalesce(file_bytes, 0)) AS BIGINT) AS total_bytes
FROM log GROUP BY ALL""",
    "rows_and_pages": f"""WITH {_LOG_CTE} SELECT run_id, dataset_key, source, status,
  CAST(sum(row_count) AS BIGINT) AS total_rows_ingested, count(*) AS total_pages
FROM log WHERE status = 'succeeded' GROUP BY ALL""",
    "event_history": f"""WITH {_LOG_CTE} SELECT event_ts, status, CAST(NULL AS VARCHAR) AS note, error_message, etag,
  last_modified FROM log WHERE dataset_key = 'key-8' ORDER BY event_ts DESC LIMIT 10""",
    "latest_run_events": f"""WITH {_LOG_CTE} SELECT run_id, dataset_key, status, event_ts FROM log
WHERE run_id = (SELECT run_id FROM log ORDER BY event_ts DESC LIMIT 1)""",
    "refresh_decisions": _REFRESH,
    "dq_not_null": f"""WITH {RATES_CTE} SELECT source_key, count(*) AS n_rows FROM rates WHERE plan_name IS NULL
GROUP BY ALL""",
    "dq_unique": "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1",
    "dq_accepted_values": """SELECT event_type, count(*) AS n_rows FROM events
WHERE event_type NOT IN ('view', 'click', 'signup') GROUP BY event_type""",
    "dq_relationships": """SELECT doc_id, count(*) AS n_rows FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "dq_unique_combination": f"""WITH {RATES_CTE} SELECT {_RATE_KEYS}, count(*) AS n_rows FROM rates
GROUP BY {_RATE_KEYS} HAVING count(*) > 1""",
    "dq_negative_rates": """SELECT c_custkey, round(c_acctbal - 2000, 6) AS negotiated_dollar FROM customer
WHERE c_acctbal - 2000 < 0""",
    "dq_report": _REPORT,
    "dq_table_checks": _TABLE_CHECKS,
    "page_reconciliation": _PAGES,
    "page_contiguity": _CONTIGUITY,
    "file_reconciliation": _FILES,
    "file_digests": """
SELECT c_custkey // 100 AS file, CAST(strlen(content) AS BIGINT) AS length, sha256(content) AS sha256 FROM (
  SELECT c_custkey // 100 AS c_custkey_file, min(c_custkey) AS c_custkey, 'hospital_name,version' || chr(10)
    || CASE WHEN (min(c_custkey) // 100) % 7 = 6 THEN 'Lakeview' ELSE 'Riverside' END || ' Campus,2.0.0' || chr(10)
    || 'description,code|1,standard_charge|gross' || chr(10)
    || string_agg(c_name || ',' || c_mktsegment || ',' || c_custkey, chr(10) ORDER BY c_custkey) || chr(10) AS content
  FROM customer GROUP BY c_custkey // 100
)""",
    "payload_sniffing": _SNIFF,
})
