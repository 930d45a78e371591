"""DuckDB statements for the corpus queries that SQL can express.

Quality rules (3), extraction (5), toxicity (6), mixing (7), language model (9) and the pipeline fit models or draw at
random; tests/llm compares them with brute force, invariants or held-out accuracy instead.
"""

_GAP = r"[\x20\x09-\x0D]+"
_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, gap: str = _GAP) -> str:
    return f"list_filter(string_split_regex({text}, '{gap}'), lambda x: x <> '')"


SUBSTRING_DEDUP = f"""
WITH texts AS (SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM texts WHERE len(words) >= 50)
),
firsts AS (SELECT k, min(doc_id) AS f FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place
  FROM windows JOIN firsts USING (k) WHERE f < doc_id
),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM placed p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place WHERE g.place IS NULL GROUP BY p.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

_TOKEN_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH texts AS (SELECT doc_id, {_words(_SMALL, _TOKEN_GAP)} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(_SMALL, _TOKEN_GAP)} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[s:s + 9], ' ') AS k
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM items WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, s, array_to_string(words[s:s + size - 1], ' ') AS k
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS s FROM texts, sizes WHERE len(words) >= size)
),
found AS (SELECT doc_id, s, d.size, item FROM doc_windows d JOIN item_windows i ON d.k = i.k AND d.size = i.size),
hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(n.items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(n.items, ','), '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT html, min(page_id) AS first FROM payloads GROUP BY html),
bits AS (
  SELECT page_id, html,
    array_to_string(list_transform(string_split(hex, ''), lambda c:
      substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS b
  FROM payloads
)
SELECT b.page_id, CAST(strlen(b.html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      16 * CAST(substr(b.b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b.b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b.b, 5 * i + 3, 1) AS INT)
      + 2 * CAST(substr(b.b, 5 * i + 4, 1) AS INT) + CAST(substr(b.b, 5 * i + 5, 1) AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN b.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN b.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM bits b JOIN firsts f USING (html)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_words(_SMALL)} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[s:s + 4], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS s FROM texts WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.component_id, t.doc_id = r.component_id AS kept
FROM texts t LEFT JOIN sizes s USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""

LINE_DEDUP = rf"""
WITH lines AS (
  SELECT doc_id, place, line,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
      unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place
    FROM documents
  )
),
crowded AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.doc_id, l.place, l.line, c.keeper IS NOT NULL AND c.keeper <> l.doc_id AS gone FROM lines l LEFT JOIN crowded c ON c.k = l.k
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_INTEGERS = "list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))"


def _clustering(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Rounds written out one after another; r0 holds the starts, rN the centroids after N rounds."""
    steps = []
    for at in range(rounds + 1):
        steps.append(f"""
a{at} AS MATERIALIZED (
  SELECT rid, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT rid, r.c, CAST(list_sum(list_transform(list_zip(v.q, r.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM vectors v, r{at} r
  ) GROUP BY rid
)""")
        if at < rounds:
            steps.append(f"""
m{at} AS (
  SELECT c, i, sum(x) // count(*) - CASE WHEN sum(x) % count(*) < 0 THEN 1 ELSE 0 END AS x
  FROM (SELECT c, unnest(q) AS x, unnest(range(1, {dims} + 1)) AS i FROM a{at} JOIN vectors USING (rid)) GROUP BY c, i
),
r{at + 1} AS MATERIALIZED (
  SELECT r.c, coalesce(n.q, r.q) AS q FROM r{at} r LEFT JOIN (SELECT c, list(CAST(x AS BIGINT) ORDER BY i) AS q FROM m{at} GROUP BY c) n USING (c)
)""")
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, {_INTEGERS} AS q FROM embeddings WHERE len(embedding) = {dims} AND {_WHOLE}
),
r0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS c, q FROM vectors
  ORDER BY c LIMIT {k}
),{",".join(steps)}
SELECT vec_id, CAST(a.c AS INT) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(r.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vectors USING (rid) JOIN r{rounds} r ON r.c = a.c
"""


URL_FILTER = r"""
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rests AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
won AS (
  SELECT rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN won USING (rid)
"""

HARD_NEGATIVES = f"""
WITH part AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    CAST({_INTEGERS} AS DOUBLE[]) AS q
  FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}
),
scored AS MATERIALIZED (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, c.vec_id AS id, c.label = a.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM part a JOIN part c ON true WHERE a.vec_id % 50 = 0
),
positive AS (
  SELECT arid, anchor_id, id, score, row_number() OVER (PARTITION BY arid ORDER BY score DESC, id NULLS LAST) AS n
  FROM scored WHERE same AND id IS DISTINCT FROM anchor_id QUALIFY n <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.arid, p.n ORDER BY s.score DESC, s.id NULLS LAST) AS INT) AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.arid = p.arid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

EXPECTED = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op2_decontamination": DECONTAMINATION,
    "op4_warc": WARC,
    "op8_near_dedup": NEAR_DEDUP,
    "op10_line_dedup": LINE_DEDUP,
    "op11_centroid_clustering": _clustering(),
    "op12_url_filter": URL_FILTER,
    "op13_hard_negatives": HARD_NEGATIVES,
}
