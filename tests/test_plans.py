"""Plans that must hold at any size: pruned scans, pushed filters, no cross joins, no ungrouped sorts of data."""

import re

import pytest
from pyspark.sql import functions as F

from newsweave.operators import joins as jn
from newsweave.operators import resolution as rs
from newsweave.plans import registry
from newsweave.sources import fixtures as fx

QUERIES = registry.queries()
LAZY = [
    "flag_union", "dedupe_keep_last", "value_ratios", "relevance_by_publisher", "duplicate_rows", "article_features", "edge_weights",
    "collapse_multi_edges", "dominant_sentiment", "undirected_graph", "degree_centrality", "in_out_centrality", "graph_view_nodes",
    "graph_view_edges", "explode_relationships", "gazetteer_entities", "cooccurrence_edges", "top_nodes", "score_histogram",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_single_task_windows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search(r"Window \[.*\], \[\]|WindowExec.*\[\]", plan)


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["dedupe_keep_last"](spark, sf_dir))
    assert all("text" not in schema for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert "EqualTo(lang,en)" in plan
    weights = plan_of(QUERIES["edge_weights"](spark, sf_dir))
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", weights)) <= {"event_id:bigint,user_id:bigint", "user_id:bigint"}


def test_hot_names_are_split_in_the_lookup(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        number = F.col("id")
        name = F.when(number % 3 == 0, F.lit("hub")).otherwise(F.concat(F.lit("n"), (number % 5000).cast("string")))
        edges = spark.range(300_000).repartition(16).select(name.alias("source"), F.concat(F.lit("t"), number.cast("string")).alias("target"))
        names = edges.select(F.col("source").alias("alias"), F.upper("source").alias("canonical")).distinct()
        mapping = rs.build_resolution_map(names, names.limit(0))
        df = jn.replace_by_map(edges, ["source"], mapping)
        assert df.filter("source = 'HUB'").count() == 100_000
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_every_query_reads_the_given_tables(spark, sf_dir):
    assert fx.articles(spark, sf_dir).inputFiles() and fx.edges(spark, sf_dir).inputFiles()
