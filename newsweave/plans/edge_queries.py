"""Queries over the edge and entity tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsweave.functions import dates as dx
from newsweave.functions import style
from newsweave.operators import aggregates as ag
from newsweave.operators import centrality as ce
from newsweave.operators import communities as co
from newsweave.operators import filters as fl
from newsweave.operators import graph as gr
from newsweave.operators import joins as jn
from newsweave.operators import ordering as od
from newsweave.operators import resolution as rs
from newsweave.operators.distribution import exact_percentiles
from newsweave.plans import views
from newsweave.plans.fixture_sql import EDGES, ENTITIES, with_
from newsweave.session import cut, work_path
from newsweave.sources import fixtures as fx
from newsweave.sources import tables as tb
from newsweave.streaming import jobs

VIEW = views.Filters(sentiment="HOSTILE", start="2024-01-05", end="2024-01-20", search="e1", article_source="US")
TERM = "e14"
CROWDED = 88


def weighted(spark, sf):
    return gr.undirected_weighted(fx.edges(spark, sf))


def named_like(spark, sf):
    """Nodes whose name contains the term."""
    return gr.graph_nodes(fx.edges(spark, sf)).filter(style.matches(F.col("node"), TERM))


def padded(spark, sf):
    return fx.edges(spark, sf).select(
        "seq",
        F.concat(F.lit("  "), "source", F.lit("\t")).alias("source"),
        F.concat("target", F.lit(" \n")).alias("target"),
        F.upper("article_source").alias("article_source"),
    )


def request_dates(spark, sf):
    events = fx.table(spark, sf, "events")
    kind, ts = F.col("event_id") % 4, F.col("ts").cast("timestamp")
    value = (
        F.when(kind == 0, F.unix_millis(ts).cast("string"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == 2, F.lit("yesterday"))
    )
    return events.select(F.col("event_id").alias("seq"), value.alias("value")).select(
        "seq", dx.request_date(F.col("value")).alias("day")
    )


def properties(spark, sf):
    types = fl.nodes_by_property(jn.first_types(fx.entities(spark, sf)), "entity_type", ["people", "locations"])
    ends = fl.endpoints_by_property(fx.edges(spark, sf), "sentiment", ["HOSTILE"])
    return types.select(F.lit("node").alias("item"), F.col("entity").alias("node")).unionByName(
        ends.select(F.lit("edge").alias("item"), "node")
    )


def domains(spark, sf):
    edges, entities = fx.edges(spark, sf), fx.entities(spark, sf)
    parts = [
        ag.domain(edges, c).select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"))
        for c in ("sentiment", "relationship", "date")
    ]
    parts.append(ag.domain(entities, "entity_type").select(F.lit("entity_type").alias("column"), "value"))
    return tb.stack_tables(parts)


def in_out_degree(spark, sf):
    edges = fx.edges(spark, sf)
    distinct = gr.degree_table(gr.edge_weights(edges).select(F.col("source").alias("src"), F.col("target").alias("dst")))
    rows = gr.row_degrees(edges)
    return distinct.select("node", F.col("in_degree").alias("in_count"), F.col("out_degree").alias("out_count")).join(
        rows.select("node", F.col("in_degree").alias("in_rows"), F.col("out_degree").alias("out_rows")), "node"
    )


def collapsed(spark, sf):
    edges = fx.edges(spark, sf).select("seq", "source", "target", "sentiment", "relationship")
    directed = od.collapse_edges(edges, directed=True).withColumn("kind", F.lit("directed"))
    return directed.unionByName(od.collapse_edges(edges, directed=False).withColumn("kind", F.lit("undirected")))


def type_partition(spark, sf):
    graph = weighted(spark, sf)
    nodes = jn.add_entity_type(gr.graph_nodes(graph, "src", "dst"), fx.entities(spark, sf))
    return graph, nodes.withColumnRenamed("entity_type", "community")


def daily_windows(spark, sf):
    """The daily slices computed by a stream over the event files."""
    path = f"{sf}/events.parquet"
    stream = jobs.stream_parquet(spark, f"{path}*", spark.read.parquet(path).schema)
    kind = F.col("event_type")
    named = stream.select(F.col("ts").cast("timestamp").alias("ts"), style.choose(kind, {
        "click": "supports", "view": "criticizes", "error": "opposes", "purchase": "partners with", "signup": "endorses"
    }, "unknown").alias("relationship"))
    sink = work_path(spark, "daily")
    jobs.daily_counts(named, "ts", ["relationship"], sink, work_path(spark, "daily-state")).awaitTermination()
    return jobs.total_counts(jobs.read_sink(spark, sink, "date date, relationship string, n bigint"), ["relationship"])


def stream_dedupe(spark, sf):
    """Distinct article addresses of a stream of interactions."""
    path = f"{sf}/events.parquet"
    stream = jobs.stream_parquet(spark, f"{path}*", spark.read.parquet(path).schema)
    url = F.format_string("https://src%d.example.com/%s", F.col("event_id") % 20, F.get_json_object("props", "$.k"))
    arrived = stream.select(F.col("ts").cast("timestamp").alias("ts"), url.alias("url"))
    sink = work_path(spark, "urls")
    jobs.first_arrivals(arrived, ["url"], "ts", sink, work_path(spark, "urls-state")).awaitTermination()
    return jobs.earliest(jobs.read_sink(spark, sink, "ts timestamp, url string").drop("batch"), ["url"], "ts").select("url")


def latest_events(spark, sf):
    """The last interaction of each user, from a stream over the events arriving as twelve files, four batches of three."""
    folder = work_path(spark, "event-files")
    events = fx.table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    events.repartition(12, "event_id").write.parquet(folder)
    stream = jobs.stream_parquet(spark, folder, events.schema, files_per_batch=3)
    sink = jobs.last_arrivals(stream, ["user_id"], "ts", work_path(spark, "last"), fan=2)
    jobs.reduced(stream, sink, work_path(spark, "last-state")).awaitTermination()
    return sink.read().select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_id", "event_type")


def view(spark, sf, part):
    return views.graph_view(fx.edges(spark, sf), fx.entities(spark, sf), VIEW)[part]


def explorer(spark, sf):
    return views.explorer_graph(fx.edges(spark, sf), views.Filters(sentiment="FRIENDLY", relationship="endorses", search=TERM))


def moved_once(spark, sf):
    """Communities after the first pass of moves, each node alone before."""
    arcs = cut(co.symmetric(weighted(spark, sf)).groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    whole = arcs.agg(F.sum("weight")).first()[0] or 0.0
    return co.move_pass(arcs.filter("src <> dst"), cut(co.alone(arcs)), whole, 1.0, 0).select("node", "community")


def moves_sql(before, after, step, half):
    """One half of the nodes moving, from a state to the next (node, k, community)."""
    active = f"CAST('0x' || md5('{step}:' || node)[1:8] AS BIGINT) % 2 = {half}"
    return f""", options_{after} AS (
  SELECT node, community, sum(w) AS w FROM (
    SELECT a.src AS node, s.community, a.weight AS w FROM arcs a JOIN {before} s ON s.node = a.dst WHERE a.src <> a.dst
    UNION ALL SELECT node, community, 0 FROM {before}) WHERE {active} GROUP BY 1, 2
), totals_{after} AS (SELECT community, sum(k) AS total, count(*) AS members FROM {before} GROUP BY 1
), scored_{after} AS (
  SELECT o.node, o.community, s.community AS own, members, o.community = s.community AS home,
    round(w - k * (total - CASE WHEN o.community = s.community THEN k ELSE 0 END) / (SELECT sum(weight) FROM arcs), 9) AS gain
  FROM options_{after} o JOIN totals_{after} t ON t.community = o.community JOIN {before} s ON s.node = o.node
), chosen_{after} AS (
  SELECT node, first(community ORDER BY gain DESC, NOT home, community) AS best,
    first(community ORDER BY gain DESC, NOT home, community) FILTER (home OR members > 1 OR community < own) AS safe,
    max(members) FILTER (home) AS size
  FROM scored_{after} GROUP BY node
), {after} AS (
  SELECT s.node, k, coalesce(CASE WHEN size > 1 THEN best ELSE safe END, s.community) AS community FROM {before} s LEFT JOIN chosen_{after} c ON c.node = s.node
)"""


def bipartite(spark, sf):
    return gr.undirected_weighted(fx.bipartite_edges(spark, sf))


def styled(spark, sf):
    nodes = views.node_style(explorer(spark, sf), fx.entities(spark, sf), TERM)
    return nodes.withColumns({c: F.round(c, 6) for c in ("in_centrality", "out_centrality", "degree_centrality", "size")})


def centralities(graph):
    found = gr.degree_centrality(graph)
    return found.withColumns({c: F.round(c, 6) for c in ("in_centrality", "out_centrality", "degree_centrality")})


def thresholds(spark, sf):
    nodes = gr.degree_centrality(weighted(spark, sf))
    return exact_percentiles(nodes, "degree_centrality", [0.9, 0.97]).select("share", F.round("value", 6).alias("threshold"))


def ranked(graph):
    return ce.pagerank(graph).select("node", F.round("pagerank", 6).alias("pagerank"))


def brokers(spark, sf):
    return ce.betweenness(weighted(spark, sf))


def metrics(spark, sf):
    found = ce.node_metrics(weighted(spark, sf))
    return found.withColumns({c: F.round(c, 6) for c in ("degree", "pagerank", "betweenness")})


def explorer_nodes(spark, sf):
    filters = views.Filters(sentiment="FRIENDLY", relationship="endorses", search=TERM)
    return views.explorer_view(fx.edges(spark, sf), fx.entities(spark, sf), filters)[0]


def first_rows(spark, sf):
    return od.keep_one(fx.entities(spark, sf), ["url", "date"], "seq", "first").select("seq", "url", "date")


def resolved_names(spark, sf):
    named = rs.unique_names(fx.edges(spark, sf), fx.entities(spark, sf))
    return named.select("name", "seq.part", F.col("seq.row").alias("row"))


QUERIES = {
    "clean_edges": lambda s, d: fl.lower_column(fl.clean_strings(padded(s, d), ["source", "target"]), "article_source"),
    "edge_filter": lambda s, d: fl.equals_or_all(
        fl.equals_or_all(fx.edges(s, d), "sentiment", "HOSTILE"), "relationship", "supports"
    ).select("seq", "source", "target"),
    "edge_date_range": lambda s, d: fl.date_range(fx.edges(s, d), "2024-01-10", "2024-01-12").select("seq", "date"),
    "edge_search": lambda s, d: tb.stack_tables(
        [
            fl.search_edges(fx.edges(s, d), "E1[0-3]$", way).select("seq", F.lit(way).alias("direction"))
            for way in ("incoming", "outgoing", "all")
        ]
    ),
    "edge_source_filter": lambda s, d: fl.from_source(fx.edges(s, d), "US").select("seq", "article_source"),
    "edge_source_list": lambda s, d: fl.from_source(fx.edges(s, d), ["French", "german"]).select("seq", "article_source"),
    "drop_self_loops": lambda s, d: fl.drop_self_loops(fx.edges(s, d)).select("seq", "source", "target"),
    "nodes_by_property": properties,
    "view_nodes": lambda s, d: views.view_nodes(views.filtered_edges(fx.edges(s, d), VIEW), fx.entities(s, d)).select(
        "entity", "entity_type", "seq"
    ),
    "node_types": lambda s, d: jn.add_entity_type(gr.graph_nodes(fx.edges(s, d)), fx.entities(s, d)),
    "dominant_sentiment": lambda s, d: jn.edge_sentiment(weighted(s, d), fx.edges(s, d)),
    "induced_subgraph": lambda s, d: jn.induced_subgraph(
        weighted(s, d), jn.first_types(fx.entities(s, d)).filter("entity_type = 'people'").select("entity")
    ),
    "domains": domains,
    "edge_weights": lambda s, d: gr.edge_weights(fx.edges(s, d)),
    "label_threshold": thresholds,
    "node_sizes_minmax": lambda s, d: ag.min_max_scale(gr.degree_centrality(weighted(s, d)), "degree_centrality", 10, 30).select(
        "node", F.round("scaled", 6).alias("scaled")
    ),
    "in_out_degree": in_out_degree,
    "dedupe_keep_first": first_rows,
    "edges_distinct": lambda s, d: fx.edges(s, d).select("source", "target", "relationship").distinct(),
    "collapse_multi_edges": collapsed,
    "view_edge_dedupe": lambda s, d: od.view_edge_dedupe(
        fx.edges(s, d).select("seq", "source", "target", "relationship", "sentiment")
    ),
    "top_nodes": lambda s, d: gr.top_nodes(fx.edges(s, d)).withColumn("degree_centrality", F.round("degree_centrality", 6)),
    "graph_nodes": lambda s, d: gr.graph_nodes(fx.edges(s, d)),
    "unique_entities": resolved_names,
    "node_style": styled,
    "parse_epoch_or_date": request_dates,
    "undirected_graph": weighted,
    "undirected_graph_sum": lambda s, d: gr.undirected_weighted(fx.edges(s, d), weight="sum"),
    "undirected_simple": lambda s, d: gr.to_undirected(gr.directed_simple(fx.edges(s, d))),
    "degree_centrality": lambda s, d: centralities(weighted(s, d)).select("node", "degree", "degree_centrality"),
    "in_out_centrality": lambda s, d: centralities(gr.directed_simple(fx.edges(s, d).select("seq", "source", "target"))),
    "modularity": lambda s, d: co.modularity(*type_partition(s, d)).select(F.round("modularity", 6).alias("modularity")),
    "degree_subgraph": lambda s, d: gr.min_degree_subgraph(weighted(s, d), CROWDED),
    "ego_search": lambda s, d: gr.ego_search(weighted(s, d), TERM),
    "khop": lambda s, d: gr.khop(weighted(s, d), named_like(s, d)),
    "label_nodes": lambda s, d: gr.label_nodes(gr.degree_centrality(weighted(s, d))).select("node", "degree"),
    "labels_above": lambda s, d: gr.labels_above(gr.degree_centrality(weighted(s, d)), "degree_centrality", 0.6).select(
        "node", "degree"
    ),
    "daily_edges": lambda s, d: gr.daily_edges(fx.edges(s, d)),
    "daily_windows": daily_windows,
    "latest_events": latest_events,
    "stream_dedupe": stream_dedupe,
    "sentiment_relationship": lambda s, d: gr.by_sentiment_and_relationship(fx.edges(s, d)),
    "edges_by_sentiment": lambda s, d: gr.edges_by(fx.edges(s, d), "sentiment"),
    "graph_view_nodes": lambda s, d: view(s, d, 0),
    "graph_view_edges": lambda s, d: view(s, d, 1),
    "graph_view_domains": lambda s, d: view(s, d, 2).withColumn("relationship_types", F.array_join("relationship_types", ",")),
    "graph_view_documents": lambda s, d: views.graph_documents(*views.graph_view(fx.edges(s, d), fx.entities(s, d), VIEW)),
    "explorer_edges": lambda s, d: views.explorer_edges(explorer(s, d)),
    "explorer_edge_titles": lambda s, d: views.edge_titles(explorer(s, d)).select("src", "dst", "title"),
    "explorer_nodes": explorer_nodes,
    "pagerank": lambda s, d: ranked(weighted(s, d)),
    "betweenness": lambda s, d: brokers(s, d).select("node", F.round("betweenness", 6).alias("betweenness")),
    "top_brokers": lambda s, d: ce.top_brokers(
        brokers(s, d).select(F.col("node").alias("entity"), F.round("betweenness", 6).alias("betweenness"))
    ),
    "node_metrics": metrics,
    "communities_first_pass": moved_once,
    "communities": lambda s, d: co.communities(weighted(s, d)),
    "community_sizes": lambda s, d: co.community_sizes(co.communities(weighted(s, d))),
    "bipartite_weights": lambda s, d: gr.edge_weights(fx.bipartite_edges(s, d)),
    "bipartite_degrees": lambda s, d: centralities(bipartite(s, d)).select("node", "degree", "degree_centrality"),
    "bipartite_pagerank": lambda s, d: ranked(bipartite(s, d)),
}

WEIGHTS = """weights AS (
  SELECT source, target, count(*) AS weight FROM edges WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2
)"""
GRAPH = """graph AS (
  SELECT least(source, target) AS src, greatest(source, target) AS dst, arg_max(weight, source) AS weight
  FROM weights GROUP BY 1, 2
)"""
LAST_DIRECTED = """directed AS (
  SELECT source AS src, target AS dst, seq, sentiment, relationship, url, date FROM {0}
  QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY seq DESC) = 1
)"""
DEGREES = """degrees AS (
  SELECT node, sum(i)::BIGINT AS in_degree, sum(o)::BIGINT AS out_degree, sum(i + o)::BIGINT AS degree
  FROM (SELECT src AS node, 0 AS i, 1 AS o FROM {0} UNION ALL SELECT dst, 1, 0 FROM {0}) GROUP BY node
), central AS (
  SELECT *, in_degree / CAST((SELECT count(*) - 1 FROM degrees) AS DOUBLE) AS in_centrality,
         out_degree / CAST((SELECT count(*) - 1 FROM degrees) AS DOUBLE) AS out_centrality,
         degree / CAST((SELECT count(*) - 1 FROM degrees) AS DOUBLE) AS degree_centrality
  FROM degrees
)"""
TYPES = """types AS (
  SELECT entity, entity_type FROM entities QUALIFY row_number() OVER (PARTITION BY entity ORDER BY seq) = 1
)"""
BASE = with_(EDGES, ENTITIES, WEIGHTS, GRAPH, DEGREES.format("graph"), TYPES)

SHOWN = f"""shown AS (
  SELECT * FROM edges
  WHERE lower(article_source) = 'us' AND sentiment = 'HOSTILE' AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
    AND (regexp_matches(lower(source), 'e1') OR regexp_matches(lower(target), 'e1'))
), directed AS (SELECT DISTINCT source AS src, target AS dst FROM shown)"""
EXPLORER = (
    "friendly AS (SELECT * FROM edges WHERE sentiment = 'FRIENDLY' AND relationship = 'endorses'), "
    + LAST_DIRECTED.format("friendly").replace("directed AS", "whole AS", 1)
    + f""", near AS (
  SELECT src AS node FROM whole WHERE contains(lower(src), '{TERM}') OR contains(lower(dst), '{TERM}')
  UNION SELECT dst FROM whole WHERE contains(lower(src), '{TERM}') OR contains(lower(dst), '{TERM}')
), directed AS (SELECT * FROM whole WHERE src IN (SELECT node FROM near) AND dst IN (SELECT node FROM near))"""
)


def pagerank_sql(source: str) -> str:
    """Power iteration over the table ``graph`` until the summed change is below a millionth per node."""
    steps = [
        "arcs AS (SELECT src, dst, weight FROM graph UNION ALL SELECT dst, src, weight FROM graph WHERE src <> dst)",
        "outs AS (SELECT src AS node, sum(weight) AS w FROM arcs GROUP BY 1)",
        """links AS MATERIALIZED (
  SELECT a.src, a.dst, CAST(a.weight AS DOUBLE) / CAST(o.w AS DOUBLE) AS share, false AS own FROM arcs a JOIN outs o ON o.node = a.src
  UNION ALL SELECT node, node, 0, true FROM outs
)""",
        """rounds AS (
  SELECT 0 AS step, node, 1.0::DOUBLE / (SELECT count(*) FROM outs) AS rank, 1.0::DOUBLE AS change FROM outs
  UNION ALL
  SELECT step, node, rank, sum(abs(rank - old)) OVER () FROM (
    SELECT r.step + 1 AS step, l.dst AS node, max(CASE WHEN l.own THEN r.rank END) AS old,
      0.85::DOUBLE * sum(r.rank * l.share) + (1 - 0.85::DOUBLE) / (SELECT count(*) FROM outs) AS rank
    FROM links l JOIN rounds r ON r.node = l.src WHERE r.change >= 1e-6::DOUBLE * (SELECT count(*) FROM outs) GROUP BY r.step, l.dst
  )
)""",
        "ranked AS (SELECT node, rank FROM rounds WHERE step = (SELECT max(step) FROM rounds))",
    ]
    return source.rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + ",\n".join(steps) + "\n"


def paths_sql(source: str, levels: int = 8) -> str:
    """Distances and path counts by unrolled levels, then betweenness by the pair formula."""
    steps = [
        "arcs AS MATERIALIZED (SELECT src, dst FROM graph WHERE src <> dst UNION ALL SELECT dst, src FROM graph WHERE src <> dst)",
        "vertices AS (SELECT src AS node FROM graph UNION SELECT dst FROM graph)",
        "p0 AS MATERIALIZED (SELECT node AS root, node, 0 AS dist, 1.0::DOUBLE AS sigma FROM vertices)",
    ]
    for i in range(1, levels + 1):
        steps.append(
            f"p{i} AS MATERIALIZED (SELECT * FROM p{i - 1} UNION ALL"
            f" SELECT p.root, a.dst, {i}, sum(p.sigma) FROM p{i - 1} p JOIN arcs a ON a.src = p.node WHERE p.dist = {i - 1}"
            f" AND NOT EXISTS (SELECT 1 FROM p{i - 1} q WHERE q.root = p.root AND q.node = a.dst) GROUP BY p.root, a.dst)"
        )
    steps.append(
        f"""through AS (
  SELECT a.node, sum(a.sigma * b.sigma / st.sigma) AS total
  FROM p{levels} a JOIN p{levels} b ON b.root = a.node JOIN p{levels} st ON st.root = a.root AND st.node = b.node
  WHERE a.root <> a.node AND b.node <> a.node AND a.root <> b.node AND a.dist + b.dist = st.dist
  GROUP BY a.node
), between_all AS (
  SELECT v.node, coalesce(t.total, 0) / CAST((SELECT (count(*) - 1) * (count(*) - 2) FROM vertices) AS DOUBLE) AS betweenness
  FROM vertices v LEFT JOIN through t ON t.node = v.node
)"""
    )
    return source.rstrip() + ",\n" + ",\n".join(steps) + "\n"


COLOR_CASE = (
    "CASE entity_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in style.TYPE_COLORS.items()) + f" ELSE '{style.OTHER_TYPE_COLOR}' END"
)
SENTIMENT_CASE = "CASE sentiment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in style.SENTIMENT_COLORS.items()) + " ELSE 'gray' END"
PERCENTILE = "(SELECT quantile_cont(degree_centrality, {0}) FROM central)"

ORACLE = {
    "clean_edges": with_(EDGES) + "SELECT seq, source, target, article_source FROM edges",
    "edge_filter": with_(EDGES)
    + "SELECT seq, source, target FROM edges WHERE sentiment = 'HOSTILE' AND relationship = 'supports'",
    "edge_date_range": with_(EDGES) + "SELECT seq, date FROM edges WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
    "edge_search": with_(EDGES)
    + """, hits AS (SELECT seq, regexp_matches(lower(source), 'e1[0-3]$') AS s, regexp_matches(lower(target), 'e1[0-3]$') AS t FROM edges)
SELECT seq, 'incoming' AS direction FROM hits WHERE t UNION ALL SELECT seq, 'outgoing' FROM hits WHERE s
UNION ALL SELECT seq, 'all' FROM hits WHERE s OR t""",
    "edge_source_filter": with_(EDGES) + "SELECT seq, article_source FROM edges WHERE article_source = 'us'",
    "edge_source_list": with_(EDGES) + "SELECT seq, article_source FROM edges WHERE article_source IN ('french', 'german')",
    "drop_self_loops": with_(EDGES) + "SELECT seq, source, target FROM edges WHERE source <> target",
    "nodes_by_property": with_(EDGES, ENTITIES, TYPES)
    + """, ends AS (SELECT * FROM edges WHERE sentiment = 'HOSTILE')
SELECT 'node' AS item, entity AS node FROM types WHERE entity_type IN ('people', 'locations')
UNION ALL SELECT 'edge', node FROM (SELECT source AS node FROM ends UNION SELECT target FROM ends)""",
    "view_nodes": with_(EDGES, ENTITIES, SHOWN)
    + """SELECT entity, entity_type, seq FROM entities
WHERE entity IN (SELECT source FROM shown UNION SELECT target FROM shown)
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY seq) = 1""",
    "node_types": BASE
    + """SELECT node, coalesce(entity_type, 'unknown') AS entity_type
FROM (SELECT source AS node FROM edges UNION SELECT target FROM edges) LEFT JOIN types ON entity = node""",
    "dominant_sentiment": BASE
    + """, counted AS (SELECT source, target, sentiment, count(*) AS n FROM edges GROUP BY 1, 2, 3
), dominant AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY n DESC, sentiment) = 1)
SELECT src, dst, coalesce(sentiment, 'neutral') AS sentiment FROM graph LEFT JOIN dominant ON source = src AND target = dst""",
    "induced_subgraph": BASE
    + """, kept AS (SELECT entity FROM types WHERE entity_type = 'people')
SELECT src, dst, weight FROM graph WHERE src IN (SELECT entity FROM kept) AND dst IN (SELECT entity FROM kept)""",
    "domains": BASE
    + """SELECT DISTINCT 'sentiment' AS "column", sentiment AS value FROM edges
UNION ALL SELECT DISTINCT 'relationship', relationship FROM edges
UNION ALL SELECT DISTINCT 'date', CAST(date AS VARCHAR) FROM edges
UNION ALL SELECT DISTINCT 'entity_type', entity_type FROM entities""",
    "edge_weights": BASE + "SELECT source, target, weight FROM weights",
    "label_threshold": BASE
    + " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS share, round({PERCENTILE.format(p)}, 6) AS threshold" for p in ("0.9", "0.97")
    ),
    "node_sizes_minmax": BASE
    + """SELECT node, round(10 + 20 * coalesce((degree_centrality - (SELECT min(degree_centrality) FROM central))
  / nullif((SELECT max(degree_centrality) - min(degree_centrality) FROM central), 0), 0), 6) AS scaled FROM central""",
    "in_out_degree": BASE
    + """, ends AS (
  SELECT source AS node, 0 AS i, 1 AS o, 0 AS ri, weight AS ro FROM weights
  UNION ALL SELECT target, 1, 0, weight, 0 FROM weights)
SELECT node, sum(i)::BIGINT AS in_count, sum(o)::BIGINT AS out_count, sum(ri)::BIGINT AS in_rows, sum(ro)::BIGINT AS out_rows
FROM ends GROUP BY node""",
    "dedupe_keep_first": with_(ENTITIES)
    + "SELECT seq, url, date FROM entities QUALIFY row_number() OVER (PARTITION BY url, date ORDER BY seq) = 1",
    "edges_distinct": with_(EDGES) + "SELECT DISTINCT source, target, relationship FROM edges",
    "collapse_multi_edges": with_(EDGES)
    + """SELECT 'directed' AS kind, source AS src, target AS dst, seq, sentiment, relationship FROM edges
QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY seq DESC) = 1
UNION ALL
SELECT 'undirected', least(source, target), greatest(source, target), seq, sentiment, relationship FROM edges
QUALIFY row_number() OVER (PARTITION BY least(source, target), greatest(source, target) ORDER BY seq DESC) = 1""",
    "view_edge_dedupe": with_(EDGES)
    + """SELECT seq, source, target, relationship, sentiment FROM edges
QUALIFY row_number() OVER (PARTITION BY source, target, relationship ORDER BY seq DESC) = 1""",
    "top_nodes": with_(EDGES, LAST_DIRECTED.format("edges"), DEGREES.format("directed"))
    + """, seen AS (
  SELECT node, min(place) AS place FROM (SELECT source AS node, seq * 2 AS place FROM edges UNION ALL SELECT target, seq * 2 + 1 FROM edges) GROUP BY 1)
SELECT node, degree, round(degree_centrality, 6) AS degree_centrality FROM central JOIN seen USING (node) ORDER BY degree DESC, place LIMIT 20""",
    "graph_nodes": with_(EDGES) + "SELECT source AS node FROM edges UNION SELECT target FROM edges",
    "unique_entities": with_(EDGES, ENTITIES)
    + """, named AS (
  SELECT source AS name, 0 AS part, seq AS "row" FROM edges UNION ALL SELECT target, 1, seq FROM edges
  UNION ALL SELECT entity, 2, seq FROM entities)
SELECT name, part, "row" FROM named QUALIFY row_number() OVER (PARTITION BY name ORDER BY part, "row") = 1""",
    "node_style": with_(EDGES, ENTITIES, TYPES, EXPLORER, DEGREES.format("directed"))
    + f""", seen AS (
  SELECT node, min(place) AS place FROM (SELECT src AS node, seq * 2 AS place FROM directed UNION ALL SELECT dst, seq * 2 + 1 FROM directed) GROUP BY 1
), ranked AS (
  SELECT c.*, coalesce(t.entity_type, 'unknown') AS entity_type, contains(lower(node), '{TERM}') AS hit,
         row_number() OVER (ORDER BY degree DESC, place) <= 20 AS is_top
  FROM central c JOIN seen USING (node) LEFT JOIN types t ON t.entity = node)
SELECT node, entity_type, round(in_centrality, 6) AS in_centrality, round(out_centrality, 6) AS out_centrality,
  round(degree_centrality, 6) AS degree_centrality,
  round((10 + 100 * degree_centrality) * CASE WHEN hit THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END, 6) AS size,
  CASE WHEN hit THEN '{style.MATCH_COLOR}' ELSE {COLOR_CASE} END AS color,
  CASE WHEN hit OR is_top THEN node ELSE '' END AS label,
  node || ' (' || entity_type || '); incoming ' || printf('%.2f', in_centrality) || '; outgoing ' || printf('%.2f', out_centrality)
    || '; total ' || printf('%.2f', degree_centrality) AS title
FROM ranked""",
    "parse_epoch_or_date": """SELECT event_id AS seq, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d')
  WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'yesterday' END AS day FROM events""",
    "undirected_graph": BASE + "SELECT src, dst, weight FROM graph",
    "undirected_graph_sum": BASE
    + "SELECT least(source, target) AS src, greatest(source, target) AS dst, sum(weight)::BIGINT AS weight FROM weights GROUP BY 1, 2",
    "undirected_simple": BASE + "SELECT src, dst, 1 AS weight FROM graph",
    "degree_centrality": BASE + "SELECT node, degree, round(degree_centrality, 6) AS degree_centrality FROM central",
    "in_out_centrality": with_(EDGES, LAST_DIRECTED.format("edges"), DEGREES.format("directed"))
    + """SELECT node, in_degree, out_degree, degree, round(in_centrality, 6) AS in_centrality,
  round(out_centrality, 6) AS out_centrality, round(degree_centrality, 6) AS degree_centrality FROM central""",
    "communities_first_pass": BASE
    + """, arcs AS (SELECT src, dst, sum(weight)::DOUBLE AS weight FROM (SELECT src, dst, weight FROM graph UNION ALL SELECT dst, src, weight FROM graph) GROUP BY 1, 2
), alone AS (SELECT src AS node, sum(weight) AS k, src AS community FROM arcs GROUP BY src)"""
    + moves_sql("alone", "halfway", 0, 0)
    + moves_sql("halfway", "moved", 0, 1)
    + "SELECT node, community FROM moved",
    "modularity": BASE
    + """, arcs AS (SELECT src, dst, weight FROM graph UNION ALL SELECT dst, src, weight FROM graph
), placed AS (
  SELECT coalesce(a.entity_type, 'unknown') AS a, coalesce(b.entity_type, 'unknown') AS b, weight
  FROM arcs LEFT JOIN types a ON a.entity = src LEFT JOIN types b ON b.entity = dst
), per AS (SELECT a, sum(CASE WHEN a = b THEN weight ELSE 0 END)::DOUBLE AS inside, sum(weight)::DOUBLE AS total FROM placed GROUP BY a)
SELECT round(sum(inside / (SELECT sum(total) FROM per) - (total / (SELECT sum(total) FROM per)) ** 2), 6) AS modularity FROM per""",
    "degree_subgraph": BASE
    + f"""SELECT src, dst, weight FROM graph WHERE src IN (SELECT node FROM degrees WHERE degree > {CROWDED})
AND dst IN (SELECT node FROM degrees WHERE degree > {CROWDED})""",
    "ego_search": BASE
    + f""", touched AS (SELECT src, dst FROM graph WHERE contains(lower(src), '{TERM}') OR contains(lower(dst), '{TERM}')
), near AS (SELECT src AS node FROM touched UNION SELECT dst FROM touched)
SELECT src, dst, weight FROM graph WHERE src IN (SELECT node FROM near) AND dst IN (SELECT node FROM near)""",
    "khop": BASE
    + f""", arcs AS (SELECT src, dst FROM graph UNION SELECT dst, src FROM graph
), h0 AS (SELECT node FROM degrees WHERE contains(lower(node), '{TERM}')
), h1 AS (SELECT dst AS node FROM arcs WHERE src IN (SELECT node FROM h0)
), h2 AS (SELECT dst AS node FROM arcs WHERE src IN (SELECT node FROM h1)
), rings AS (SELECT node, 0 AS hop FROM h0 UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2)
SELECT node, min(hop) AS hop FROM rings GROUP BY node""",
    "label_nodes": BASE + f"SELECT node, degree FROM central WHERE degree_centrality >= {PERCENTILE.format('0.9')}",
    "labels_above": BASE + "SELECT node, degree FROM central WHERE degree_centrality >= 0.6::DOUBLE",
    "daily_edges": with_(EDGES) + "SELECT date, relationship, count(*) AS n FROM edges GROUP BY 1, 2",
    "latest_events": """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC, event_type DESC) = 1""",
    "daily_windows": with_(EDGES) + "SELECT date, relationship, count(*) AS n FROM edges GROUP BY 1, 2",
    "stream_dedupe": with_(EDGES) + "SELECT DISTINCT url FROM edges",
    "sentiment_relationship": with_(EDGES)
    + """SELECT s.sentiment, r.relationship,
  (SELECT count(*) FROM edges e WHERE e.sentiment = s.sentiment AND e.relationship = r.relationship) AS n
FROM (SELECT DISTINCT sentiment FROM edges) s, (SELECT DISTINCT relationship FROM edges) r""",
    "edges_by_sentiment": with_(EDGES)
    + "SELECT sentiment, count(*) AS n, count(DISTINCT source || '|' || target) AS pairs FROM edges GROUP BY 1",
    "graph_view_nodes": with_(EDGES, ENTITIES, TYPES, SHOWN, DEGREES.format("directed"))
    + """SELECT node AS id, node AS label, entity_type AS "group", entity_type AS type, 'dot' AS shape,
  round(degree_centrality, 4) AS centrality, in_degree AS in_count, out_degree AS out_count
FROM central JOIN types ON entity = node""",
    "graph_view_edges": with_(EDGES, SHOWN)
    + """SELECT source AS "from", target AS "to", relationship AS label, sentiment, CAST(date AS VARCHAR) AS date, url, 'to' AS arrows FROM shown""",
    "graph_view_domains": with_(EDGES, SHOWN)
    + """SELECT (SELECT string_agg(DISTINCT relationship, ',' ORDER BY relationship) FROM edges) AS relationship_types,
  CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date FROM shown""",
    "explorer_edges": with_(EDGES, EXPLORER)
    + f"SELECT src, dst, sentiment, relationship, url, date, {SENTIMENT_CASE} AS color FROM directed",
    "explorer_edge_titles": with_(EDGES, EXPLORER)
    + """SELECT src, dst, concat_ws('; ', 'from ' || src, 'to ' || dst, 'relationship ' || relationship, 'sentiment ' || sentiment,
  'date ' || CAST(date AS VARCHAR)) AS title FROM directed""",
    "pagerank": pagerank_sql(BASE) + "SELECT node, round(rank, 6) AS pagerank FROM ranked",
    "betweenness": paths_sql(BASE) + "SELECT node, round(betweenness, 6) AS betweenness FROM between_all",
    "top_brokers": paths_sql(BASE)
    + """SELECT node AS entity, round(betweenness, 6) AS betweenness FROM between_all
ORDER BY round(betweenness, 6) DESC, node LIMIT 5""",
    "node_metrics": paths_sql(pagerank_sql(BASE).replace("arcs AS (", "both_ways AS (").replace("FROM arcs", "FROM both_ways"))
    + """SELECT c.node AS entity, round(degree_centrality, 6) AS degree, round(rank, 6) AS pagerank, round(betweenness, 6) AS betweenness
FROM central c JOIN ranked r ON r.node = c.node JOIN between_all b ON b.node = c.node""",
    "bipartite_weights": """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS source, 'P' || CAST(l_partkey AS VARCHAR) AS target,
  count(*) AS weight FROM lineitem GROUP BY 1, 2""",
}
BIPARTITE = with_(
    "edges AS (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS source, 'P' || CAST(l_partkey AS VARCHAR) AS target FROM lineitem)",
    WEIGHTS, GRAPH, DEGREES.format("graph"),
)
ORACLE["bipartite_degrees"] = BIPARTITE + "SELECT node, degree, round(degree_centrality, 6) AS degree_centrality FROM central"
ORACLE["bipartite_pagerank"] = pagerank_sql(BIPARTITE) + "SELECT node, round(rank, 6) AS pagerank FROM ranked"
