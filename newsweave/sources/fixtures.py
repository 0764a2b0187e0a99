"""Logical article, edge, entity, response, name and score tables derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsweave.session import scalar
from newsweave.sources.tables import spread

KEYWORDS = ["the", "with", "from"]
# token, tag
LEXICON = [
    ("is", "VERB"), ("was", "VERB"), ("are", "VERB"), ("be", "VERB"), ("ist", "VERB"),
    ("et", "CONJ"), ("und", "CONJ"), ("the", "DET"), ("of", "ADP"), ("la", "DET"),
]
# surface, entity type
GAZETTEER = [
    ("the", "people"), ("and", "people"), ("of", "institutions"), ("that", "institutions"),
    ("with", "political_events"), ("from", "political_events"), ("la", "political_parties"),
    ("le", "political_parties"), ("der", "locations"), ("el", "locations"), ("in that", "locations"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and texts of the articles, straight from the scan."""
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "text"))


def articles(spark: SparkSession, sf_dir: str, heavy: bool = False, text: Column | None = None) -> DataFrame:
    """``heavy`` spreads a small input over all cores before costly text expressions.

    ``text`` is put in place of the text on the scan, so that what is made of it goes through the joins, not the text.
    """
    documents = table(spark, sf_dir, "documents")
    if heavy:
        documents = spread(documents)
    if text is not None:
        documents = documents.withColumn("text", text)
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("page_url"))
    labels = table(spark, sf_dir, "labels")
    made_up = F.format_string("https://%s.example.com/%s/%d", "source", "lang", F.col("n_chars") % 97)
    return (
        documents.join(pages, "doc_id", "left")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("seq"),
            F.coalesce("page_url", made_up).alias("url"),
            "text",
            F.when(
                F.col("doc_id") % 101 != 0,
                F.timestamp_seconds(F.lit(1717200000) + (F.col("doc_id") % 1000) * 18000),
            ).alias("datetime"),
            F.col("lang").alias("language"),
            F.col("quality").alias("relevance_text"),
            F.col("toxic").alias("relevance_description"),
            (1 - F.col("doc_id") % 2).cast("int").alias("is_us_election"),
            (F.col("doc_id") % 2).cast("int").alias("is_french_election"),
            F.lit(0).alias("is_german_election"),
        )
    )


def edges(spark: SparkSession, sf_dir: str, prefix: str = "E") -> DataFrame:
    events = table(spark, sf_dir, "events")
    node_count = scalar(events, F.max("user_id") + 1)
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("source"),
        F.concat(F.lit(prefix), ((F.col("user_id") * 31 + F.col("event_id")) % node_count).cast("string")).alias("target"),
        F.when(kind == "click", "supports")
        .when(kind == "view", "criticizes")
        .when(kind == "error", "opposes")
        .when(kind == "purchase", "partners with")
        .when(kind == "signup", "endorses")
        .alias("relationship"),
        F.when(F.col("value") < 20, "HOSTILE").when(F.col("value") < 55, "NEUTRAL").otherwise("FRIENDLY").alias("sentiment"),
        F.to_date("ts").alias("date"),
        F.element_at(F.array(F.lit("us"), F.lit("french"), F.lit("german")), (F.col("event_id") % 3 + 1).cast("int")).alias(
            "article_source"
        ),
        F.format_string("https://src%d.example.com/%s", F.col("event_id") % 20, F.get_json_object("props", "$.k")).alias("url"),
    )


def entities(spark: SparkSession, sf_dir: str, prefix: str = "E") -> DataFrame:
    types = F.array(*[F.lit(t) for t in ("people", "institutions", "political_events", "political_parties", "locations")])
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("user_id") % 17 != 0)
        .select(
            F.col("event_id").alias("seq"),
            F.format_string("https://src%d.example.com/%s", F.col("event_id") % 20, F.get_json_object("props", "$.k")).alias("url"),
            F.to_date("ts").alias("date"),
            F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("entity"),
            F.element_at(types, (F.col("user_id") % 5 + 1).cast("int")).alias("entity_type"),
        )
    )


def bipartite_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("source"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("target"),
    )


# Reply texts by doc_id mod 10; %P, %Q and %L stand for two people and a place.
RESPONSES = [
    "Nothing to report today.",
    '{"entities": {"people": ["%P"',
    "{}",
    '{"entities": {"people": ["%P"]}, "entity_relationships": [{"source": "%P", "target": "%Q", "relationship": "supports"}]}',
    '{"entities": {"people": [], "institutions": [], "political_events": [], "political_parties": [], "locations": []},'
    ' "entity_relationships": []}',
    '{"entities": {"people": ["%P", "%Q"], "locations": "%L"}, "entity_relationships":'
    ' [{"source": "%P", "target": "%Q", "relationship": "opposes", "sentiment": "HOSTILE"}]}',
    '{"entities": {"people": ["%P"], "locations": ["%L"]}, "entity_relationships":'
    ' [{"source": "%P", "target": "%Q", "relationship": "leads", "sentiment": null}]}',
    'Here it is:\n```json\n{"entities": {"people": ["%P", "%Q"], "institutions": ["I1"]}, "entity_relationships":'
    ' [{"source": "%P", "target": "%Q", "relationship": "endorses", "sentiment": "FRIENDLY"}]}\n```\nDone.',
    '{"entities": {"people": ["%P"]}, "entity_relationships": [17, {"source": "%P", "target": "%Q",'
    ' "relationship": "accuses", "sentiment": "HOSTILE"}]}',
    '{"entities": {"people": ["%P", "%Q"], "locations": ["%L"]}, "entity_relationships":'
    ' [{"source": "%P", "target": "%Q", "relationship": "supports", "sentiment": "FRIENDLY"},'
    ' {"source": "%Q", "target": "%P", "relationship": "represents", "sentiment": "NEUTRAL"}]}',
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies per article, one shape per doc_id mod 10."""
    doc = F.col("seq")
    shape = F.element_at(F.array(*[F.lit(text) for text in RESPONSES]), (doc % 10 + 1).cast("int"))
    for mark, name in (
        ("%P", F.concat(F.lit("P"), (doc % 40).cast("string"))),
        ("%Q", F.concat(F.lit("P"), (doc * 7 % 40).cast("string"))),
        ("%L", F.concat(F.lit("L"), (doc % 7).cast("string"))),
    ):
        shape = F.replace(shape, F.lit(mark), name)
    base = articles(spark, sf_dir).select("seq", "url", F.to_date("datetime").alias("date"), "relevance_text")
    return base.withColumn("response_text", shape).withColumn("error", F.lit(None).cast("string"))


def name_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("name"), F.col("vec_id").alias("seq"), "embedding"
    )


def overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-made corrections: identities, single hops forming chains, and an alias nobody uses."""
    ids = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % 50 < 4)
    rest = F.col("vec_id") % 50
    alias = F.when(rest == 0, F.concat(F.lit("unused"), F.col("vec_id").cast("string"))).otherwise(
        F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    )
    canonical = F.when(rest == 1, alias).otherwise(F.concat(F.lit("V"), (F.col("vec_id") + 1).cast("string")))
    return ids.select(alias.alias("alias"), canonical.alias("canonical"))


TITLES = ["Mr. ", "Mrs ", "Dr. ", "Prime Minister ", "President ", "Prof. Dr. ", "Drake ", "", "Chancellor\t", "Ms.  "]


def title(number: Column) -> Column:
    """One of the ten honorifics."""
    return F.element_at(F.array(*[F.lit(t) for t in TITLES]), (number % 10 + 1).cast("int"))


def titled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names with honorifics before, inside and after them."""
    key = F.col("c_custkey")
    inside = F.when(key % 3 == 0, F.lit(" Mr. X  ")).when(key % 3 == 1, F.lit("")).otherwise(F.lit(" "))
    return table(spark, sf_dir, "customer").select(key.alias("seq"), F.concat(title(key), F.col("c_name"), inside).alias("name"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, sf_dir, "labels").select(
        doc.alias("id"),
        F.col("quality").alias("y"),
        ((doc * 7919 % 1000) / F.lit(2000) + F.lit(0.45) * F.col("quality")).alias("prob"),
        F.when(doc % 5 == 0, F.lit("valid")).otherwise(F.lit("train")).alias("split"),
    )
