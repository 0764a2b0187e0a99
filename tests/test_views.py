import datetime as dt
import json

import pytest

from newsweave.operators import graph as gr
from newsweave.plans import views

DAY = dt.date(2024, 1, 1)
EDGES = [
    (1, "Ann", "Bob", "supports", "FRIENDLY", DAY, "us", "u1"),
    (2, "Ann", "Bob", "opposes", "HOSTILE", dt.date(2024, 1, 5), "french", "u2"),
    (3, "Bob", "Cyd", "leads", "NEUTRAL", dt.date(2024, 1, 9), "us", "u3"),
    (4, "Dan", "Eve", "leads", "NEUTRAL", None, "german", "u4"),
]
TYPES = [(1, "u1", DAY, "Ann", "people"), (2, "u2", DAY, "Ann", "locations"), (3, "u3", DAY, "Bob", "people"), (4, "u3", DAY, "Zoe", "people")]


@pytest.fixture(scope="module")
def tables(spark):
    edges = spark.createDataFrame(
        EDGES, "seq bigint, source string, target string, relationship string, sentiment string, date date, article_source string, url string"
    )
    return edges, spark.createDataFrame(TYPES, "seq bigint, url string, date date, entity string, entity_type string")


def test_untyped_nodes_are_left_out_of_the_dashboard(tables):
    nodes, edges, domains = views.graph_view(*tables)
    found = {r["id"]: r for r in nodes.collect()}
    assert set(found) == {"Ann", "Bob"} and edges.count() == 4
    assert found["Ann"]["type"] == "people" and found["Ann"]["centrality"] == 0.25
    assert (found["Bob"]["in_count"], found["Bob"]["out_count"]) == (1, 1)
    kept = views.graph_view(*tables, keep_untyped=True)[0]
    assert {r["id"]: r["type"] for r in kept.collect()}["Eve"] == "unknown"


def test_domains_mix_all_and_kept_edges(tables):
    by = views.Filters(relationship="supports")
    row = views.graph_view(*tables, by)[2].first()
    assert row["relationship_types"] == ["leads", "opposes", "supports"]
    assert (row["min_date"], row["max_date"]) == ("2024-01-01", "2024-01-01")


def test_filters_combine(tables):
    by = views.Filters(article_source="US", start="2024-01-01", end="2024-01-31", search="BOB", direction="incoming")
    assert [r["from"] for r in views.graph_view(*tables, by)[1].collect()] == ["Ann"]


def test_documents(tables):
    parts = views.graph_documents(*views.graph_view(*tables)).collect()
    assert sorted(r["part"] for r in parts) == ["domain"] + ["edge"] * 4 + ["node"] * 2
    undated = [json.loads(r["document"]) for r in parts if r["part"] == "edge" and "u4" in r["document"]]
    assert undated[0]["date"] is None


def test_explorer_keeps_untyped_nodes(tables):
    nodes, edges = views.explorer_view(*tables, views.Filters(search="ann"))
    found = {r["node"]: r for r in nodes.collect()}
    assert set(found) == {"Ann", "Bob"}
    assert found["Ann"]["color"] == "#ff0000" and found["Ann"]["size"] == 165.0
    assert found["Ann"]["community"] == found["Bob"]["community"]
    assert f"; community {found['Ann']['community']}; incoming " in found["Ann"]["title"]
    assert [(r["sentiment"], r["color"]) for r in edges.collect()] == [("HOSTILE", "red")]
    assert edges.first()["title"].startswith("from Ann; to Bob; relationship ")
    everything = views.explorer_view(*tables)[0]
    assert {r["node"]: r["entity_type"] for r in everything.collect()}["Eve"] == "unknown"


def test_top_nodes_break_ties_by_first_appearance(tables):
    assert [r["node"] for r in gr.top_nodes(tables[0], 4).collect()] == ["Bob", "Ann", "Cyd", "Dan"]


def test_profile(spark):
    rows = [
        (1, "https://a.org/1", "one two", dt.datetime(2024, 1, 1), "en", 1, 0, 1, 0),
        (2, "https://a.org/1", "one", dt.datetime(2024, 1, 2), "en", 0, None, 1, 0),
        (3, "https://b.org/1", None, None, "en", None, 1, 0, 1),
        (4, "https://b.org/2", "un", None, "fr", 1, 1, 0, 1),
    ]
    articles = spark.createDataFrame(
        rows,
        "seq bigint, url string, text string, datetime timestamp, language string, relevance_text int, relevance_description int,"
        " is_us_election int, is_french_election int",
    )
    profile = {name: df.collect() for name, df in views.eda_profile(articles).items()}
    assert profile["languages"][0] == ("en", 3)
    assert profile["publishers"] == [(2,)]
    assert [r["seq"] for r in profile["label_queue"]] == [3]
    assert profile["text_lengths"] == [(0, 500, 1)]
    assert profile["relevance_by_publisher"] == [("a.org", 0.0), ("b.org", None)]
    assert dict(map(tuple, profile["nulls"]))["text"] == 1
    assert profile["duplicates"] == [(0,)]
    features = {r["seq"]: r for r in views.article_features(articles).collect()}
    assert features[1]["news_org"] == "a.org" and features[1]["day_of_week"] == "Monday"
    assert features[3]["word_count"] == 0 and features[3]["is_weekend"] is False and features[3]["article_type"] == "other"


def test_resolution_end_to_end(spark):
    edges = spark.createDataFrame([(1, "A", "B", "leads"), (2, "A1", "B", "leads"), (3, "A", "A1", "leads")], "seq bigint, source string, target string, relationship string")
    entities = spark.createDataFrame([(1, "u", "A", "people"), (2, "u", "A1", "people")], "seq bigint, url string, entity string, entity_type string")
    vectors = spark.createDataFrame([("A", 0, [1.0, 0.0]), ("A1", 1, [0.99, 0.05]), ("B", 2, [0.0, 1.0])], "name string, seq bigint, embedding array<float>")
    overrides = spark.createDataFrame([("B", "Bee")], "alias string, canonical string")
    new_edges, new_entities, mapping = views.resolve(edges, entities, vectors, overrides)
    assert new_edges.collect() == [("A", "Bee", "leads")]
    assert [(r["seq"], r["entity"]) for r in new_entities.collect()] == [(1, "A")]
    assert mapping.count() == 3
