"""Queries over names and vectors: similarity, clusters, corrections and rewriting."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsweave.functions import text as tx
from newsweave.functions import vectors as vx
from newsweave.operators import aggregates as ag
from newsweave.operators import resolution as rs
from newsweave.operators.similarity import similar_pairs
from newsweave.plans import views
from newsweave.plans.fixture_sql import CLUSTERS, PAIRS, TITLED, VECTORS, edges, entities, quote, with_
from newsweave.sources import fixtures as fx

THRESHOLD = 0.35


def neighbours(spark, sf):
    """Cosine of each vector with the next one."""
    vectors = fx.name_vectors(spark, sf)
    following = vectors.select((F.col("seq") - 1).alias("seq"), F.col("embedding").alias("other"))
    return vectors.join(following, "seq").select("seq", F.round(vx.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def clusters(spark, sf):
    return rs.cluster_names(fx.name_vectors(spark, sf), THRESHOLD)


def mapping(spark, sf):
    return rs.build_resolution_map(clusters(spark, sf), fx.overrides(spark, sf))


def resolved(spark, sf):
    """Edges and entities after rewriting, before cleaning."""
    names = mapping(spark, sf)
    return rs.apply_resolution(fx.edges(spark, sf, "V"), ["source", "target"], names), rs.apply_resolution(
        fx.entities(spark, sf, "V"), ["entity"], names
    )


def resolved_graph(spark, sf):
    return rs.clean_resolved(*resolved(spark, sf))


def cluster_lists(spark, sf):
    found = ag.clusters_by_canonical(mapping(spark, sf))
    return found.select("canonical", "part", F.array_join("aliases", ",").alias("aliases"), "number_of_names_in_cluster")


def encoded_names(spark, sf):
    """Default name vectors, summarised: dimension count and length."""
    names = fx.titled_names(spark, sf).select("seq", tx.normalize_title(F.col("name")).alias("name"))
    found = rs.name_embedding(names)
    return found.select("seq", F.size("embedding").alias("dims"), F.round(vx.norm(F.col("embedding")), 4).alias("length"))


CORRECTIONS = [("E3", "E4"), ("unused", "E1")]


def from_names(spark, sf):
    """Edges, entities and map, from edges whose sources carry honorifics to the graph resolved by the letters of the names."""
    edges = fx.edges(spark, sf).withColumn("source", F.concat(fx.title(F.col("seq")), "source"))
    corrections = spark.createDataFrame(CORRECTIONS, "alias string, canonical string")
    return views.resolve_names(edges, fx.entities(spark, sf), corrections, rs.letter_embedding)


QUERIES = {
    "resolved_from_names": lambda s, d: from_names(s, d)[0],
    "resolved_entities_from_names": lambda s, d: from_names(s, d)[1].select("seq", "url", "entity", "entity_type"),
    "resolution_totals": lambda s, d: ag.resolution_totals(from_names(s, d)[2]),
    "cosine": neighbours,
    "similar_pairs": lambda s, d: similar_pairs(fx.name_vectors(s, d), THRESHOLD).withColumn("cosine", F.round("cosine", 6)),
    "normalize_names": lambda s, d: fx.titled_names(s, d).select("seq", tx.normalize_title(F.col("name")).alias("name")),
    "name_vectors": encoded_names,
    "greedy_clusters": clusters,
    "resolution_map": mapping,
    "resolve_edges": lambda s, d: resolved(s, d)[0].select("seq", "source", "target"),
    "resolve_entities": lambda s, d: resolved(s, d)[1].select("seq", "entity"),
    "resolved_graph": lambda s, d: resolved_graph(s, d)[0].select(
        "source", "target", "relationship", "sentiment", "date", "article_source", "url"
    ),
    "resolved_entities": lambda s, d: resolved_graph(s, d)[1].select("seq", "url", "entity"),
    "name_clusters": cluster_lists,
    "cluster_size_hist": lambda s, d: ag.cluster_sizes(mapping(s, d)),
}

RESOLVED = (
    CLUSTERS
    + ", "
    + edges("V", "raw_edges")
    + ", "
    + entities("V", "raw_entities")
    + """, edges AS (
  SELECT e.* REPLACE (coalesce(a.canonical, e.source) AS source, coalesce(b.canonical, e.target) AS target)
  FROM raw_edges e LEFT JOIN mapping a ON a.alias = e.source LEFT JOIN mapping b ON b.alias = e.target
), entities AS (
  SELECT e.* REPLACE (coalesce(m.canonical, e.entity) AS entity) FROM raw_entities e LEFT JOIN mapping m ON m.alias = e.entity
)"""
)

TITLE_CASE = "CASE seq % 10 " + " ".join(f"WHEN {i} THEN {quote(t) if chr(9) not in t else quote(t.strip()) + ' || chr(9)'}" for i, t in enumerate(fx.TITLES)) + " END"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: From raw_edges and raw_entities to the resolved ones.
CHAIN = rf"""sightings AS (
  SELECT source AS name, 0 AS part, seq FROM raw_edges UNION ALL SELECT target, 1, seq FROM raw_edges UNION ALL SELECT entity, 2, seq FROM raw_entities
), firsts AS (
  SELECT regexp_replace(regexp_replace(name, '\b(Mr|Ms|Mrs|Dr|Prof|President|Chancellor|Prime Minister)\.?\s+', '', 'g'), '^\s+|\s+$', '', 'g') AS name,
         min((part, seq)) AS first
  FROM sightings WHERE name IS NOT NULL GROUP BY 1
), vectors AS (
  SELECT name, row_number() OVER (ORDER BY first, name) - 1 AS seq,
         list_transform(string_split('{LETTERS}', ''), lambda c: CAST(length(name) - length(replace(lower(name), c, '')) AS DOUBLE)) AS v
  FROM firsts
), pairs AS (
  SELECT a.seq AS left_seq, b.seq AS right_seq FROM vectors a JOIN vectors b ON a.seq < b.seq
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) > 0.88
), earlier AS (SELECT right_seq AS seq, list(left_seq) AS before FROM pairs GROUP BY right_seq
), steps AS (SELECT v.seq, coalesce(e.before, CAST([] AS BIGINT[])) AS before FROM vectors v LEFT JOIN earlier e ON e.seq = v.seq
), walk AS (
  SELECT seq, [seq] AS leaders FROM steps WHERE seq = 0
  UNION ALL
  SELECT s.seq, CASE WHEN list_has_any(w.leaders, s.before) THEN w.leaders ELSE list_append(w.leaders, s.seq) END
  FROM walk w JOIN steps s ON s.seq = w.seq + 1
), leaders AS (SELECT unnest(leaders) AS seq FROM (SELECT leaders FROM walk ORDER BY seq DESC LIMIT 1)
), chosen AS (
  SELECT v.seq, max(l.seq) AS leader FROM vectors v JOIN leaders l
    ON l.seq = v.seq OR l.seq IN (SELECT left_seq FROM pairs p WHERE p.right_seq = v.seq)
  GROUP BY v.seq
), corrections AS (SELECT * FROM (VALUES {", ".join(f"({quote(a)}, {quote(c)})" for a, c in CORRECTIONS)}) t(alias, canonical)
), mapping AS (
  SELECT coalesce(o.alias, a.name) AS alias, coalesce(o.canonical, c.name) AS canonical
  FROM chosen x JOIN vectors a ON a.seq = x.seq JOIN vectors c ON c.seq = x.leader FULL JOIN corrections o ON o.alias = a.name
), edges AS (
  SELECT e.* REPLACE (coalesce(a.canonical, e.source) AS source, coalesce(b.canonical, e.target) AS target)
  FROM raw_edges e LEFT JOIN mapping a ON a.alias = e.source LEFT JOIN mapping b ON b.alias = e.target
), entities AS (
  SELECT e.* REPLACE (coalesce(m.canonical, e.entity) AS entity) FROM raw_entities e LEFT JOIN mapping m ON m.alias = e.entity
)"""

FROM_NAMES = (
    edges("E", "plain_edges")
    + f""", raw_edges AS (SELECT * REPLACE ({TITLE_CASE} || source AS source) FROM plain_edges), """
    + entities("E", "raw_entities")
    + ", "
    + CHAIN
)

ORACLE = {
    "resolved_from_names": with_(FROM_NAMES, recursive=True)
    + "SELECT DISTINCT source, target, relationship, sentiment, date, article_source, url FROM edges WHERE source <> target",
    "resolved_entities_from_names": with_(FROM_NAMES, recursive=True)
    + "SELECT seq, url, entity, entity_type FROM entities QUALIFY row_number() OVER (PARTITION BY url, entity ORDER BY seq) = 1",
    "resolution_totals": with_(FROM_NAMES, recursive=True)
    + "SELECT count(*) AS names, count(DISTINCT canonical) AS canonicals, count(*) FILTER (alias <> canonical) AS merged FROM mapping",
    "cosine": with_(VECTORS)
    + """SELECT a.seq, round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cosine
FROM vectors a JOIN vectors b ON b.seq = a.seq + 1""",
    "similar_pairs": with_(PAIRS) + 'SELECT "left", "right", left_seq, right_seq, round(cosine, 6) AS cosine FROM pairs',
    "normalize_names": with_(TITLED)
    + r"""SELECT seq, regexp_replace(regexp_replace(name,
  '\b(Mr|Ms|Mrs|Dr|Prof|President|Chancellor|Prime Minister)\.?\s+', '', 'g'), '^\s+|\s+$', '', 'g') AS name FROM titled""",
    "name_vectors": "SELECT c_custkey AS seq, 256 AS dims, 1.0::DOUBLE AS length FROM customer",
    "greedy_clusters": with_(CLUSTERS, recursive=True) + "SELECT alias, canonical, is_leader FROM clusters",
    "resolution_map": with_(CLUSTERS, recursive=True) + "SELECT alias, canonical FROM mapping",
    "resolve_edges": with_(RESOLVED, recursive=True) + "SELECT seq, source, target FROM edges",
    "resolve_entities": with_(RESOLVED, recursive=True) + "SELECT seq, entity FROM entities",
    "resolved_graph": with_(RESOLVED, recursive=True)
    + """SELECT DISTINCT source, target, relationship, sentiment, date, article_source, url FROM edges WHERE source <> target""",
    "resolved_entities": with_(RESOLVED, recursive=True)
    + "SELECT seq, url, entity FROM entities QUALIFY row_number() OVER (PARTITION BY url, entity ORDER BY seq) = 1",
    "name_clusters": with_(CLUSTERS, recursive=True)
    + """SELECT canonical, 0::BIGINT AS part, string_agg(alias, ',' ORDER BY alias) AS aliases, count(*) AS number_of_names_in_cluster
FROM mapping GROUP BY canonical HAVING count(*) > 1""",
    "cluster_size_hist": with_(CLUSTERS, recursive=True)
    + """SELECT number_of_names_in_cluster, count(*) AS number_of_clusters
FROM (SELECT count(*) AS number_of_names_in_cluster FROM mapping GROUP BY canonical HAVING count(*) > 1) GROUP BY 1""",
}
