"""Queries over model replies: parsing, exploding and joining with the articles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from newsweave.functions import text as tx
from newsweave.operators import aggregates as ag
from newsweave.operators import extraction as ex
from newsweave.operators import filters as fl
from newsweave.operators import resolution as rs
from newsweave.operators.joins import join_on_key
from newsweave.operators.numbering import numbered
from newsweave.operators.ordering import keep_one
from newsweave.plans import views
from newsweave.plans.article_queries import MENTION_TYPE, MENTIONED, SENTENCES
from newsweave.plans.fixture_sql import ARTICLES, CATEGORIES, RELATIONS, RESPONSES_SQL, with_
from newsweave.plans.name_queries import CHAIN
from newsweave.session import cut, work_path
from newsweave.sources import fixtures as fx
from newsweave.sources.tables import stack_tables
from newsweave.streaming import jobs


def parsed(spark, sf):
    return ex.parse_responses(fx.responses(spark, sf))


def nested(spark, sf):
    return ex.parse_nested(parsed(spark, sf))


def nested_profile(spark, sf):
    """Sizes and contents of the parsed cells, flattened to text."""
    return nested(spark, sf).select(
        "seq",
        F.array_join(F.array_sort(F.map_keys("entities")), ",").alias("categories"),
        F.size("relationships").alias("relationships"),
        F.size(F.filter("relationships", lambda m: F.size(m) > 0)).alias("objects"),
    )


def cells(spark, sf):
    """Two kinds of nested cells below one another, with blank ones among them."""
    both = parsed(spark, sf).select(F.explode(F.array("extracted_entities", "entity_relationships")).alias("cell"), "seq")
    return both.select(F.when(F.col("seq") % 25 == 0, F.lit("{broken")).otherwise(F.col("cell")).alias("cell"))


def features(spark, sf):
    text = fx.articles(spark, sf).select("seq", F.when(F.col("seq") % 9 != 0, F.col("text")).otherwise(F.lit(" ")).alias("text"))
    found = ex.entity_features(nested(spark, sf).join(text, "seq"))
    return found.select(
        "seq", "entity_count", F.round("entity_to_word_ratio", 6).alias("entity_to_word_ratio"), "mentions_organizations"
    )


def joined(spark, sf):
    articles = fx.articles(spark, sf).select("seq", "url", "language")
    replies = parsed(spark, sf).select("seq", "url", "extracted_entities")
    return join_on_key(articles, replies)


def graph_tables(spark, sf):
    """Edges and entities of the relevant articles.

    Addresses repeat among the articles, so both sides are reduced to one row per address first.
    """
    one = keep_one(fx.articles(spark, sf).select("seq", "url", "datetime", "relevance_text"), ["url"], "seq", "last")
    features = one.select("seq", "url", F.to_date("datetime").alias("date"), "relevance_text")
    replies = keep_one(parsed(spark, sf).select("seq", "url", "extracted_entities", "entity_relationships"), ["url"], "seq", "last").drop("seq")
    return views.build_graph_tables(features, replies)


def flat_edges(edges):
    return edges.select("*", F.col("seq.article").alias("article"), F.col("seq.position").alias("position")).drop("seq")


#: Characters of text in an arriving file of ``run_stream``, about.
CHARS_PER_FILE = 16_000_000


def run_stream(spark, sf):
    """Extraction over the documents arriving as files, in several batches and two runs, the second of which brings all of them again.

    Returns what the written results say per address: names by type, and pairs of names that follow each other.
    """
    folder, sink, errors, state = (work_path(spark, name) for name in ("arrivals", "results", "errors", "extract-state"))
    url = F.format_string("https://%s.example.com/%s/%d", "source", "lang", F.col("n_chars") % 97)
    documents = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), url.alias("url"), "text")
    # as many files as the texts ask for; all articles of an address arrive in one
    files = max(4, math.ceil((documents.agg(F.sum(F.length("text"))).first()[0] or 0) / CHARS_PER_FILE))
    documents = documents.repartition(files, "url")
    for _ in range(2):
        documents.write.mode("append").parquet(folder)
        stream = jobs.stream_parquet(spark, folder, documents.schema, files_per_batch=math.ceil(files / 2))
        jobs.incremental_extract(stream, ex.gazetteer_extractor(fx.GAZETTEER), sink, errors, state).awaitTermination()
    found = ex.parse_nested(jobs.read_sink(spark, sink, jobs.RESULTS).drop("batch"))
    names = found.select("url", F.explode_outer("entities").alias("what", "names")).select("url", "what", F.explode("names").alias("one"))
    pairs = found.select("url", F.explode("relationships").alias("r")).select("url", F.col("r")["source"].alias("one"), F.col("r")["target"].alias("other"))
    articles = found.select("url", F.lit("article").alias("what"))
    rows = [articles, names, pairs.withColumn("what", F.lit("pair"))]
    return stack_tables(rows).select("url", "what", "one", "other")


def graph_from_texts(spark, sf):
    """The whole way from the texts of the articles: extractor, replies, graph tables, names resolved by their letters."""
    one = cut(keep_one(fx.articles(spark, sf, heavy=True), ["url"], "seq", "last"))
    replies = ex.extraction_results(ex.parse_responses(ex.gazetteer_extractor(fx.GAZETTEER)(one)))
    features = one.select("seq", "url", F.to_date("datetime").alias("date"), "relevance_text")
    tables = views.build_graph_tables(features, cut(replies))
    edges, entities = (numbered(t.withColumnRenamed("seq", "at"), "seq", F.asc("at")).drop("at") for t in tables)
    nothing = spark.createDataFrame([], "alias string, canonical string")
    return views.resolve_names(edges, entities, nothing, rs.letter_embedding)


def failed_replies(spark, sf):
    """Replies of which some failed outright, a part of these at a rate limit."""
    doc = F.col("seq")
    error = F.when(doc % 13 == 0, F.lit("HTTP 429: Rate Limit reached")).when(doc % 13 == 5, F.lit("Quota exceeded")).when(doc % 13 == 7, F.lit("no such model"))
    found = fx.responses(spark, sf).withColumn("error", error)
    return ex.parse_responses(found.withColumn("response_text", F.when(error.isNull(), F.col("response_text"))))


QUERIES = {
    "graph_from_texts": lambda s, d: graph_from_texts(s, d)[0],
    "entities_from_texts": lambda s, d: graph_from_texts(s, d)[1].select("url", "date", "entity", "entity_type"),
    "failed_results": lambda s, d: ex.extraction_results(failed_replies(s, d)),
    "failed_errors": lambda s, d: ex.extraction_errors(failed_replies(s, d)),
    "json_block": lambda s, d: fx.responses(s, d).select("seq", tx.json_block(F.col("response_text")).alias("block")),
    "parse_responses": parsed,
    "parse_nested": nested_profile,
    "extraction_errors": lambda s, d: ex.extraction_errors(parsed(s, d)),
    "extraction_results": lambda s, d: ex.extraction_results(parsed(s, d), retry_failed=True),
    "nonempty_extractions": lambda s, d: fl.nonempty(nested(s, d), "relationships", "entities").select("seq", "url", "date"),
    "explode_relationships": lambda s, d: flat_edges(ex.explode_relationships(nested(s, d))),
    "explode_entities": lambda s, d: ex.explode_entities(nested(s, d)).select("seq.article", "url", "date", "entity", "entity_type"),
    "entity_features": features,
    "type_profile": lambda s, d: ag.value_types(cells(s, d), "cell"),
    "join_features_extractions": joined,
    "graph_table_edges": lambda s, d: flat_edges(graph_tables(s, d)[0]),
    "graph_table_entities": lambda s, d: graph_tables(s, d)[1].select("seq.article", "url", "date", "entity", "entity_type"),
    "incremental_extract": run_stream,
}

ALL_KEPT = "kept AS (SELECT * FROM parsed)"
HAS_RELATIONS = "json_array_length(entity_relationships) > 0 AND len(json_keys(extracted_entities)) > 0"
GRAPH_KEPT = f"""features AS (
  SELECT seq, url, CAST(datetime AS DATE) AS date, relevance_text FROM articles
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1
), replies AS (
  SELECT url, extracted_entities, entity_relationships FROM parsed
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1
), kept AS (
  SELECT f.seq, f.url, f.date, extracted_entities, entity_relationships
  FROM features f JOIN replies r ON r.url = f.url
  WHERE relevance_text = 1 AND {HAS_RELATIONS}
  QUALIFY row_number() OVER (PARTITION BY f.url, f.date ORDER BY f.seq) = 1
)"""
EDGE_ROWS = "SELECT source, target, relationship, sentiment, url, date, seq AS article, position FROM relations"
ENTITY_ROWS = "SELECT seq AS article, url, date, entity, entity_type FROM names"

FAILED = (
    RESPONSES_SQL
    + """, failed AS (
  SELECT url, CASE WHEN seq % 13 IN (0, 5, 7) THEN '{}' ELSE extracted_entities END AS extracted_entities,
    CASE WHEN seq % 13 IN (0, 5, 7) THEN '[]' ELSE entity_relationships END AS entity_relationships,
    CASE seq % 13 WHEN 0 THEN 'HTTP 429: Rate Limit reached' WHEN 5 THEN 'Quota exceeded' WHEN 7 THEN 'no such model' ELSE error END AS error
  FROM parsed)"""
)
FROM_TEXTS = (
    ARTICLES.replace("articles AS (", "every AS (", 1).replace("FROM articles WHERE", "FROM every WHERE", 1)
    + ", articles AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1), "
    + SENTENCES
    + MENTIONED
    + f""", stepped AS (
  SELECT DISTINCT seq, names[i] AS source, names[i + 1] AS target FROM (SELECT *, unnest(range(1, len(names))) AS i FROM named)
), linked AS (SELECT * FROM stepped WHERE source <> target
), kept AS (SELECT seq, url, CAST(datetime AS DATE) AS date FROM articles WHERE relevance_text = 1 AND seq IN (SELECT seq FROM linked)
), raw_edges AS (
  SELECT row_number() OVER (ORDER BY seq, source, target) AS seq, source, target, 'partners with' AS relationship, 'NEUTRAL' AS sentiment, url, date
  FROM kept JOIN linked USING (seq)
), listed AS (
  SELECT DISTINCT seq, url, date, entity, {MENTION_TYPE} AS entity_type FROM kept JOIN (SELECT seq, unnest(names) AS entity FROM named) USING (seq)
), raw_entities AS (SELECT row_number() OVER (ORDER BY seq, entity_type, entity) AS seq, url, date, entity, entity_type FROM listed
), """
    + CHAIN
)

ORACLE = {
    "graph_from_texts": with_(FROM_TEXTS, recursive=True)
    + "SELECT DISTINCT source, target, relationship, sentiment, url, date FROM edges WHERE source <> target",
    "entities_from_texts": with_(FROM_TEXTS, recursive=True)
    + "SELECT url, date, entity, entity_type FROM entities QUALIFY row_number() OVER (PARTITION BY url, entity ORDER BY seq) = 1",
    "failed_results": with_(FAILED) + "SELECT url, extracted_entities, entity_relationships FROM failed",
    "failed_errors": with_(FAILED)
    + "SELECT url, error, regexp_matches(lower(error), 'rate limit|quota|429') AS rate_limited FROM failed WHERE error IS NOT NULL",
    "json_block": with_(RESPONSES_SQL) + "SELECT seq, block FROM blocks",
    "parse_responses": with_(RESPONSES_SQL)
    + "SELECT seq, url, date, relevance_text, extracted_entities, entity_relationships, error FROM parsed",
    "parse_nested": with_(RESPONSES_SQL)
    + """SELECT seq, array_to_string(list_sort(json_keys(extracted_entities)), ',') AS categories,
  CAST(json_array_length(entity_relationships) AS INTEGER) AS relationships,
  CAST(len(list_filter(json_extract(entity_relationships, '$[*]'), lambda e: json_type(e) = 'OBJECT')) AS INTEGER) AS objects
FROM parsed""",
    "extraction_errors": with_(RESPONSES_SQL)
    + """SELECT url, error, regexp_matches(lower(error), 'rate limit|quota|429') AS rate_limited FROM parsed WHERE error IS NOT NULL""",
    "extraction_results": with_(RESPONSES_SQL)
    + "SELECT url, extracted_entities, entity_relationships FROM parsed WHERE error IS NULL",
    "nonempty_extractions": with_(RESPONSES_SQL) + f"SELECT seq, url, date FROM parsed WHERE {HAS_RELATIONS}",
    "explode_relationships": with_(RESPONSES_SQL, ALL_KEPT, RELATIONS) + EDGE_ROWS,
    "explode_entities": with_(RESPONSES_SQL, ALL_KEPT, CATEGORIES) + ENTITY_ROWS,
    "entity_features": with_(RESPONSES_SQL, ALL_KEPT, CATEGORIES)
    + r""", per AS (
  SELECT seq, count(*) AS c, count_if(entity_type = 'institutions') AS i FROM names GROUP BY seq
), words AS (
  SELECT seq, CASE WHEN seq % 9 <> 0 THEN len(regexp_extract_all(text, '[^\s\x0b\x1c-\x1f\x{85}\pZ]+')) ELSE 0 END AS w FROM articles)
SELECT p.seq, CAST(coalesce(c, 0) AS INTEGER) AS entity_count,
  round(CAST(coalesce(c, 0) AS DOUBLE) / nullif(w, 0), 6) AS entity_to_word_ratio, coalesce(i, 0) > 0 AS mentions_organizations
FROM parsed p JOIN words USING (seq) LEFT JOIN per ON per.seq = p.seq""",
    "type_profile": with_(RESPONSES_SQL)
    + """SELECT CASE WHEN seq % 25 = 0 THEN 'unreadable' ELSE kind END AS kind, count(*) AS n
FROM (SELECT seq, unnest(['object', 'array']) AS kind FROM parsed) GROUP BY 1""",
    "join_features_extractions": with_(RESPONSES_SQL)
    + """SELECT a.url, a.seq AS seq_x, a.language, p.seq AS seq_y, p.extracted_entities
FROM articles a JOIN parsed p ON p.url = a.url""",
    "graph_table_edges": with_(RESPONSES_SQL, GRAPH_KEPT, RELATIONS) + EDGE_ROWS,
    "graph_table_entities": with_(RESPONSES_SQL, GRAPH_KEPT, CATEGORIES) + ENTITY_ROWS,
    "incremental_extract": with_(
        r"""last AS (
  SELECT doc_id AS seq, 'https://' || source || '.example.com/' || lang || '/' || CAST(n_chars % 97 AS VARCHAR) AS url, text
  FROM documents QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id DESC) = 1
)""",
        r"""articles AS (SELECT * FROM last WHERE regexp_matches(text, '[^\s\x0b\x1c-\x1f\x{85}\pZ]'))""",
        SENTENCES,
    )
    + f"""{MENTIONED}, pairs AS (
  SELECT url, names[i] AS one, names[i + 1] AS other FROM (SELECT *, unnest(range(1, len(names))) AS i FROM named)
)
SELECT url, 'article' AS what, CAST(NULL AS VARCHAR) AS one, CAST(NULL AS VARCHAR) AS other FROM articles
UNION ALL SELECT DISTINCT url, {MENTION_TYPE}, entity, NULL FROM (SELECT url, unnest(names) AS entity FROM named)
UNION ALL SELECT DISTINCT url, 'pair', one, other FROM pairs WHERE one <> other""",
}
