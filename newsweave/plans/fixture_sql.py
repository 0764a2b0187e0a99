"""DuckDB definitions of the logical tables in sources.fixtures, as common table expressions."""

from __future__ import annotations

from newsweave.sources.fixtures import RESPONSES, TITLES


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ARTICLES = """articles AS (
  SELECT d.doc_id AS seq,
         coalesce(p.url, 'https://' || d.source || '.example.com/' || d.lang || '/' || CAST(d.n_chars % 97 AS VARCHAR)) AS url,
         d.text AS text,
         CASE WHEN d.doc_id % 101 <> 0
              THEN TIMESTAMP '2024-06-01 00:00:00' + to_hours(CAST((d.doc_id % 1000) * 5 AS INTEGER)) END AS datetime,
         d.lang AS language,
         l.quality AS relevance_text,
         l.toxic AS relevance_description,
         CAST(1 - d.doc_id % 2 AS INTEGER) AS is_us_election,
         CAST(d.doc_id % 2 AS INTEGER) AS is_french_election,
         CAST(0 AS INTEGER) AS is_german_election
  FROM documents d
  LEFT JOIN pages p ON p.page_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
), english AS (SELECT * FROM articles WHERE language = 'en'
), uniq AS (
  SELECT * FROM english QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1
)"""

PUBLISHER = r"regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"


def edges(prefix: str = "E", name: str = "edges") -> str:
    return f"""{name} AS (
  SELECT event_id AS seq,
         '{prefix}' || CAST(user_id AS VARCHAR) AS source,
         '{prefix}' || CAST((user_id * 31 + event_id) % (SELECT max(user_id) + 1 FROM events) AS VARCHAR) AS target,
         CASE event_type WHEN 'click' THEN 'supports' WHEN 'view' THEN 'criticizes' WHEN 'error' THEN 'opposes'
              WHEN 'purchase' THEN 'partners with' WHEN 'signup' THEN 'endorses' END AS relationship,
         CASE WHEN value < 20 THEN 'HOSTILE' WHEN value < 55 THEN 'NEUTRAL' ELSE 'FRIENDLY' END AS sentiment,
         CAST(ts AS DATE) AS date,
         CASE event_id % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'french' ELSE 'german' END AS article_source,
         'https://src' || CAST(event_id % 20 AS VARCHAR) || '.example.com/' || json_extract_string(props, '$.k') AS url
  FROM events
)"""


def entities(prefix: str = "E", name: str = "entities") -> str:
    return f"""{name} AS (
  SELECT event_id AS seq,
         'https://src' || CAST(event_id % 20 AS VARCHAR) || '.example.com/' || json_extract_string(props, '$.k') AS url,
         CAST(ts AS DATE) AS date,
         '{prefix}' || CAST(user_id AS VARCHAR) AS entity,
         CASE user_id % 5 WHEN 0 THEN 'people' WHEN 1 THEN 'institutions' WHEN 2 THEN 'political_events'
              WHEN 3 THEN 'political_parties' ELSE 'locations' END AS entity_type
  FROM events WHERE user_id % 17 <> 0
)"""


EDGES = edges()
ENTITIES = entities()

RESPONSE_TABLE = (
    "responses AS (\n  SELECT seq, url, CAST(datetime AS DATE) AS date, relevance_text,\n"
    "         replace(replace(replace(CASE seq % 10\n"
    + "\n".join(f"           WHEN {i} THEN {quote(text)}" for i, text in enumerate(RESPONSES))
    + """
         END, '%P', 'P' || CAST(seq % 40 AS VARCHAR)), '%Q', 'P' || CAST(seq * 7 % 40 AS VARCHAR)),
         '%L', 'L' || CAST(seq % 7 AS VARCHAR)) AS response_text
  FROM articles
), blocks AS (
  SELECT *, nullif(regexp_extract(response_text, '\\{(?s:.*)\\}', 0), '') AS block FROM responses
), parsed AS (
  SELECT seq, url, date, relevance_text,
         CASE WHEN block IS NOT NULL AND json_valid(block)
              THEN coalesce(CAST(json_extract(block, '$.entities') AS VARCHAR), '{}') ELSE '{}' END AS extracted_entities,
         CASE WHEN block IS NOT NULL AND json_valid(block)
              THEN coalesce(CAST(json_extract(block, '$.entity_relationships') AS VARCHAR), '[]') ELSE '[]' END
              AS entity_relationships,
         CASE WHEN block IS NULL THEN 'no JSON object in the reply'
              WHEN NOT json_valid(block) THEN 'the reply is not valid JSON' END AS error
  FROM blocks
)"""
)
RESPONSES_SQL = ARTICLES + ", " + RESPONSE_TABLE

# elements of relationship lists that are objects with all four keys
RELATIONS = """elements AS (
  SELECT seq, url, date, CAST(i AS INTEGER) AS position, json_extract(entity_relationships, '$[' || CAST(i AS VARCHAR) || ']') AS element
  FROM (SELECT *, unnest(range(0, CAST(json_array_length(entity_relationships) AS BIGINT))) AS i FROM kept)
), relations AS (
  SELECT json_extract_string(element, '$.source') AS source, json_extract_string(element, '$.target') AS target,
         json_extract_string(element, '$.relationship') AS relationship, json_extract_string(element, '$.sentiment') AS sentiment,
         url, date, seq, position
  FROM elements
  WHERE json_type(element) = 'OBJECT'
    AND list_has_all(json_keys(element), ['source', 'target', 'relationship', 'sentiment'])
)"""
CATEGORIES = """categories AS (
  SELECT seq, url, date, k AS entity_type, json_extract(extracted_entities, '$.' || k) AS names
  FROM (SELECT *, unnest(json_keys(extracted_entities)) AS k FROM kept)
), names AS (
  SELECT url, date, seq, entity_type, unnest(from_json(names, '["VARCHAR"]')) AS entity
  FROM categories WHERE json_type(names) = 'ARRAY'
)"""

VECTORS = """vectors AS (
  SELECT 'V' || CAST(vec_id AS VARCHAR) AS name, vec_id AS seq, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
)"""
PAIRS = (
    VECTORS
    + """, pairs AS (
  SELECT a.name AS "left", b.name AS "right", a.seq AS left_seq, b.seq AS right_seq,
         list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS cosine
  FROM vectors a JOIN vectors b ON a.seq < b.seq
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) > 0.35
)"""
)
# the scan over the names in order, one name per step, carrying the list of leaders
CLUSTERS = (
    PAIRS
    + """, earlier AS (SELECT right_seq AS seq, list(left_seq) AS before FROM pairs GROUP BY right_seq
), steps AS (SELECT v.seq, coalesce(e.before, CAST([] AS BIGINT[])) AS before FROM vectors v LEFT JOIN earlier e ON e.seq = v.seq
), walk AS (
  SELECT seq, [seq] AS leaders FROM steps WHERE seq = 0
  UNION ALL
  SELECT s.seq, CASE WHEN list_has_any(w.leaders, s.before) THEN w.leaders ELSE list_append(w.leaders, s.seq) END
  FROM walk w JOIN steps s ON s.seq = w.seq + 1
), leaders AS (SELECT unnest(leaders) AS seq FROM (SELECT leaders FROM walk ORDER BY seq DESC LIMIT 1)
), chosen AS (
  SELECT v.seq, max(l.seq) AS leader
  FROM vectors v JOIN leaders l ON l.seq = v.seq OR l.seq IN (SELECT left_seq FROM pairs p WHERE p.right_seq = v.seq)
  GROUP BY v.seq
), clusters AS (
  SELECT 'V' || CAST(seq AS VARCHAR) AS alias, 'V' || CAST(leader AS VARCHAR) AS canonical, seq = leader AS is_leader FROM chosen
), overrides AS (
  SELECT CASE vec_id % 50 WHEN 0 THEN 'unused' ELSE 'V' END || CAST(vec_id AS VARCHAR) AS alias,
         CASE vec_id % 50 WHEN 1 THEN 'V' || CAST(vec_id AS VARCHAR) ELSE 'V' || CAST(vec_id + 1 AS VARCHAR) END AS canonical
  FROM embeddings WHERE vec_id % 50 < 4
), mapping AS (
  SELECT coalesce(o.alias, c.alias) AS alias, coalesce(o.canonical, c.canonical) AS canonical
  FROM clusters c FULL JOIN overrides o ON o.alias = c.alias
)"""
)

TITLED = (
    "titled AS (\n  SELECT c_custkey AS seq, CASE c_custkey % 10\n"
    + "\n".join(f"    WHEN {i} THEN {quote(t) if chr(9) not in t else quote(t.strip()) + ' || chr(9)'}" for i, t in enumerate(TITLES))
    + "\n  END || c_name || CASE c_custkey % 3 WHEN 0 THEN ' Mr. X  ' WHEN 1 THEN '' ELSE ' ' END AS name FROM customer\n)"
)

SCORED = """scored AS (
  SELECT doc_id AS id, quality AS y,
         CAST(doc_id * 7919 % 1000 AS DOUBLE) / 2000 + CAST(0.45 AS DOUBLE) * quality AS prob,
         CASE WHEN doc_id % 5 = 0 THEN 'valid' ELSE 'train' END AS split
  FROM labels
)"""


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"
