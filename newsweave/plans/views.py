"""The compositions a user asks for: graph views, profiles, features, graph tables and resolution."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsweave.functions import dates as dx
from newsweave.functions import style
from newsweave.functions import text as tx
from newsweave.operators import aggregates as ag
from newsweave.operators import extraction as ex
from newsweave.operators import filters as fl
from newsweave.operators import graph as gr
from newsweave.operators import resolution as rs
from newsweave.operators.communities import communities
from newsweave.operators.joins import add_entity_type, join_on_key, with_keys
from newsweave.operators.ordering import duplicate_count, duplicate_rows, keep_one
from newsweave.session import cut
from newsweave.sources.tables import default_column


@dataclass(frozen=True)
class Filters:
    """Choices of a view; the defaults keep everything."""

    sentiment: str = fl.ALL
    relationship: str = fl.ALL
    search: str = ""
    start: str | None = None
    end: str | None = None
    direction: str = "all"
    article_source: str | Sequence[str] = ""
    mode: str = "regex"


def filtered_edges(edges: DataFrame, by: Filters) -> DataFrame:
    kept = fl.from_source(edges, by.article_source)
    kept = fl.equals_or_all(kept, "sentiment", by.sentiment)
    kept = fl.equals_or_all(kept, "relationship", by.relationship)
    kept = fl.date_range(kept, by.start, by.end)
    return fl.search_edges(kept, by.search, by.direction, by.mode)


def view_nodes(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """First entity row of every entity that is an end of an edge.

    Entities are reduced to their first rows before the join, which then meets one row per name on both sides.
    """
    return with_keys(keep_one(entities, ["entity"]), "entity", gr.graph_nodes(edges))


def graph_view(edges: DataFrame, entities: DataFrame, by: Filters = Filters(), keep_untyped: bool = False):
    """(nodes, edges, domains) of the dashboard.

    Ends without an entity row are left out of the nodes, while their edges stay, unless ``keep_untyped``.
    """
    kept = filtered_edges(edges, by)
    pairs = kept.select(F.col("source").alias("src"), F.col("target").alias("dst")).filter("src is not null and dst is not null")
    degrees = gr.degree_centrality(pairs.distinct())
    # each node row comes from the degree table itself, so the kept edges are not scanned again for a semi join
    wanted = ["entity", "entity_type", "seq"] + (["article_source"] if "article_source" in entities.columns else [])
    typed = keep_one(entities.select(*wanted), ["entity"]).withColumnRenamed("entity", "node")
    joined = degrees.join(typed, "node", "left" if keep_untyped else "inner")
    kind = F.coalesce("entity_type", F.lit("unknown")) if keep_untyped else F.col("entity_type")
    shape = style.source_shape(F.col("article_source")) if "article_source" in entities.columns else F.lit("dot")
    nodes = joined.select(
        F.col("node").alias("id"),
        F.col("node").alias("label"),
        kind.alias("group"),
        kind.alias("type"),
        shape.alias("shape"),
        F.round("degree_centrality", 4).alias("centrality"),
        F.col("in_degree").alias("in_count"),
        F.col("out_degree").alias("out_count"),
    )
    shown = kept.select(
        F.col("source").alias("from"),
        F.col("target").alias("to"),
        F.col("relationship").alias("label"),
        "sentiment",
        dx.date_text(F.col("date")).alias("date"),
        "url",
        F.lit("to").alias("arrows"),
    )
    kinds = edges.agg(F.sort_array(F.collect_set("relationship")).alias("relationship_types"))
    spans = kept.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    domains = kinds.withColumns(
        {
            "min_date": dx.date_text(spans.select("a").scalar()),
            "max_date": dx.date_text(spans.select("b").scalar()),
        }
    )
    return nodes, shown, domains


def graph_documents(nodes: DataFrame, edges: DataFrame, domains: DataFrame) -> DataFrame:
    """The view as JSON rows (part, document): one per node and edge, one for the domains."""

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("part"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("document"))

    return part(nodes, "node").unionByName(part(edges, "edge")).unionByName(part(domains, "domain"))


def explorer_graph(edges: DataFrame, by: Filters = Filters()) -> DataFrame:
    """Directed edges kept by sentiment, relationship and dates, then by the neighbourhood of the search term."""
    kept = fl.equals_or_all(edges, "sentiment", by.sentiment)
    kept = fl.equals_or_all(kept, "relationship", by.relationship)
    kept = fl.date_range(kept, by.start, by.end)
    return gr.ego_search(gr.directed_simple(kept), by.search)


def explorer_edges(graph: DataFrame) -> DataFrame:
    return graph.select(
        "src", "dst", "sentiment", "relationship", "url", "date", style.sentiment_color(F.col("sentiment")).alias("color")
    )


def edge_titles(graph: DataFrame) -> DataFrame:
    """``explorer_edges`` with hover text."""
    title = style.edge_hover(*[F.col(c) for c in ("src", "dst", "relationship", "sentiment", "date")])
    return explorer_edges(graph).withColumn("title", title)


def node_style(graph: DataFrame, entities: DataFrame, term: str = "", n_top: int = 20, groups: DataFrame | None = None) -> DataFrame:
    """Nodes with type, centralities, size, colour, label and hover text; untyped nodes are ``unknown``.

    ``groups`` (node, community) adds the community as a column and to the hover text.
    """
    degrees = gr.degree_centrality(graph)
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.struct("seq", F.lit(0)).alias("at")),
        F.struct(F.col("dst").alias("node"), F.struct("seq", F.lit(1)).alias("at")),
    )
    seen = graph.select(F.explode(ends).alias("e")).select("e.*").groupBy("node").agg(F.min("at").alias("at"))
    top = degrees.join(seen, "node").orderBy(F.desc("degree"), "at").limit(n_top).select("node", F.lit(True).alias("is_top"))
    typed = add_entity_type(degrees.join(F.broadcast(top), "node", "left"), entities)
    community = []
    if groups is not None:
        typed, community = typed.join(groups, "node", "left"), [F.col("community")]
    matched = style.matches(F.col("node"), term)
    total = F.col("degree_centrality")
    return typed.select(
        "node",
        "entity_type",
        "in_centrality",
        "out_centrality",
        "degree_centrality",
        style.explorer_size(total, matched).alias("size"),
        F.when(matched, F.lit(style.MATCH_COLOR)).otherwise(style.type_color(F.col("entity_type"))).alias("color"),
        F.when(F.coalesce("is_top", F.lit(False)) | matched, F.col("node")).otherwise(F.lit("")).alias("label"),
        style.hover(F.col("node"), F.col("entity_type"), F.col("in_centrality"), F.col("out_centrality"), total, *community).alias("title"),
        *community,
    )


def explorer_view(edges: DataFrame, entities: DataFrame, by: Filters = Filters()):
    """(nodes, edges) of the explorer page, nodes with their community."""
    graph = explorer_graph(edges, by)
    groups = communities(gr.to_undirected(graph))
    return node_style(graph, entities, by.search, groups=groups), edge_titles(graph)


def article_features(
    articles: DataFrame,
    lexicon: DataFrame | None = None,
    keywords: Sequence[str] = tuple(tx.ELECTION_KEYWORDS),
    kinds: Sequence[tuple[str, str]] = (("analysis", "analysis"), ("interview", "interview")),
) -> DataFrame:
    """Articles with publisher, date, election countdown and text features."""
    ts = F.col("datetime")
    df = articles.withColumn("datetime", dx.parse_lenient(ts)) if dict(articles.dtypes)["datetime"] == "string" else articles
    df = df.withColumns(
        {
            "news_org": tx.publisher(F.col("url")),
            "date": dx.calendar_date(ts),
            "day_of_week": dx.day_name(ts),
            "month": F.month(ts),
            "is_weekend": dx.is_weekend(ts),
            "days_until_us_election": dx.days_until(ts, dx.US_ELECTION),
            "days_until_french_election": dx.days_until(ts, dx.FRENCH_ELECTION),
            "word_count": tx.word_count(F.col("text")),
            "mentions_election_keywords": tx.mentions_any(F.col("text"), keywords),
            "article_type": tx.article_type(F.col("text"), kinds),
        }
    )
    df = default_column(df, "language", "en")
    if lexicon is None:
        return df
    words = [r["token"] for r in lexicon.filter("tag = 'VERB'").select("token").distinct().limit(ex.SHORT_LEXICON + 1).collect()]
    if len(words) <= ex.SHORT_LEXICON:
        return df.withColumn("verb_count", tx.lexicon_count(F.col("text"), [w.lower() for w in words]))
    counts = ex.count_lexicon(articles, lexicon).withColumnRenamed("count", "verb_count")
    return df.join(counts, "seq", "left")


def eda_profile(articles: DataFrame) -> dict[str, DataFrame]:
    """The tables of the exploratory profile, by name."""
    english = fl.language_is(articles)
    unique = keep_one(english, ["url"], "seq", "last")
    # texts are measured before the latest rows are picked: only their lengths are shuffled
    measured = english.withColumn("text_length", tx.text_length(F.col("text"))).drop("text")
    slim = keep_one(measured, ["url"], "seq", "last")
    published = slim.withColumns({"publisher": tx.publisher(F.col("url")), "date": F.to_date("datetime")})
    daily = ag.mean_by(published, "date", "relevance_text")
    return {
        "languages": ag.value_counts(articles, "language"),
        "column_counts": ag.column_counts(english),
        "duplicates": duplicate_count(english.drop("seq")),
        "duplicate_rows": duplicate_rows(english.drop("seq")),
        "description_ratios": ag.value_ratios(slim, "relevance_description"),
        "label_ratios": ag.value_ratios(slim, "relevance_text"),
        "nulls": ag.null_profile(keep_one(english.withColumn("text", ag.presence("text")), ["url"], "seq", "last")),
        "label_queue": fl.label_queue(unique),
        "publishers": ag.distinct_count(published, "publisher"),
        "publisher_counts": ag.value_counts(published, "publisher"),
        "relevance_by_publisher": ag.mean_by(published, "publisher", "relevance_text").orderBy(F.desc("mean"), "publisher"),
        "text_lengths": ag.histogram(slim, "text_length", 500),
        "daily_relevance": daily,
        "spike_days": daily.orderBy(F.desc("mean"), "date").limit(10),
        "relevant_share": ag.share_of_all(slim, ["is_us_election", "is_french_election"]),
    }


def build_graph_tables(features: DataFrame, extractions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, entities) from relevant articles joined with their extractions."""
    joined = fl.relevant_only(join_on_key(features, extractions))
    parsed = ex.parse_nested(joined.select("seq", "url", "date", "extracted_entities", "entity_relationships"))
    kept = keep_one(fl.nonempty(parsed, "relationships", "entities").drop("extracted_entities", "entity_relationships"), ["url", "date"])
    return ex.explode_relationships(kept), ex.explode_entities(kept)


def resolve(edges: DataFrame, entities: DataFrame, vectors: DataFrame, overrides: DataFrame, threshold: float = 0.88):
    """(edges, entities, mapping) with names rewritten through clusters and corrections, then cleaned."""
    mapping = rs.build_resolution_map(rs.cluster_names(vectors, threshold), overrides)
    new_edges, new_entities = rs.clean_resolved(
        rs.apply_resolution(edges, ["source", "target"], mapping), rs.apply_resolution(entities, ["entity"], mapping)
    )
    return new_edges, new_entities, mapping


def resolve_names(
    edges: DataFrame, entities: DataFrame, overrides: DataFrame, encode: Callable[[DataFrame], DataFrame] = rs.name_embedding, threshold: float = 0.88
):
    """``resolve`` from the names themselves: numbered as first seen without honorifics, encoded by ``encode``, clustered, corrected, rewritten."""
    names = cut(encode(rs.ranked_names(edges, entities)).select("name", "seq", "embedding"))
    return resolve(edges, entities, names, overrides, threshold)
