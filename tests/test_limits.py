"""Inputs beyond the limits an earlier version had: long entries and chains, stored Python cells, odd replies, numbers and CSV cells."""

import pytest
from pyspark.sql import functions as F

from newsweave.functions import dates as dx
from newsweave.functions import nested as nx
from newsweave.operators import extraction as ex
from newsweave.operators import resolution as rs
from newsweave.session import work_path
from newsweave.sources import tables as tb

PEOPLE = [("Robert Kennedy Junior", "person"), ("Joe  Biden", "person"), ("Trump", "person")]


def test_entries_of_any_word_count(spark):
    text = "Robert Kennedy Junior met Joe Biden and Trump. Joe Biden praised Trump."
    articles = spark.createDataFrame([("u", 1, text), ("v", 2, None)], "url string, seq bigint, text string")
    found = {r.entity: r.mentions for r in ex.gazetteer_entities(articles, PEOPLE).collect()}
    assert found == {"robert kennedy junior": 1, "joe biden": 2, "trump": 2}
    links = {(r.source, r.target): r.n for r in ex.cooccurrence_edges(articles, PEOPLE).collect()}
    assert links == {("robert kennedy junior", "joe biden"): 1, ("joe biden", "trump"): 2}
    assert ex.gazetteer_entities(articles, []).count() == 0


def test_chains_of_any_length(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("s", "s"), ("t", "s"), ("p", "q"), ("q", "p")]
    found = {r.alias: r.canonical for r in rs.follow_chains(spark.createDataFrame(links, "alias string, canonical string")).collect()}
    assert {found[f"n{i}"] for i in range(40)} == {"n40"} and found["s"] == found["t"] == "s"
    assert [found[k] for k in "abcxpq"] == ["c", "a", "b", "c", "q", "p"]
    assert len(found) == len(links)


@pytest.mark.parametrize(
    "cell,expected",
    [
        ("{'sentiment': None, 'a': True, 'b': False}", {"sentiment": None, "a": "true", "b": "false"}),
        ("\n {'a': 'None of \"True\" North', \"b\": \"isn't None\"}\n", {"a": 'None of "True" North', "b": "isn't None"}),
        ('{"None": "x", "Nine": "None"}', {"None": "x", "Nine": "None"}),
        ("None", {}),
    ],
)
def test_stored_cells(spark, cell, expected):
    row = spark.createDataFrame([(cell,)], "cell string").select(nx.text_map(F.col("cell")).alias("m")).first()
    assert row.m == expected


def test_stored_relationships_with_none(spark):
    cell = "[{'source': 'A', 'target': 'B', 'relationship': 'meets', 'sentiment': None}, {'source': 'N'}]"
    found = spark.createDataFrame([(cell,)], "cell string").select(nx.relationship_maps(F.col("cell")).alias("m")).first().m
    assert found == [{"source": "A", "target": "B", "relationship": "meets", "sentiment": None}, {"source": "N"}]


def test_replies_are_read_strictly(spark):
    replies = ['{"entities": {"a": 1}} and also {"x": 1}', "{'entities': {}}", '{"entities": {"a": 1}, "entities": {"b": 2}}', 'say {"entities": {"c": 3}} done']
    rows = [(str(i), r, None) for i, r in enumerate(replies)]
    found = ex.parse_responses(spark.createDataFrame(rows, "url string, response_text string, error string")).orderBy("url").collect()
    assert [r.error is None for r in found] == [False, False, True, True]
    assert [r.extracted_entities for r in found[2:]] == ['{"b":2}', '{"c":3}']


def test_extreme_numbers_pass(spark):
    values = ["1e18", "-1e300", "9223372036854", "NaN", "Infinity"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", dx.request_date(F.col("v")).alias("d")).orderBy("i")
    assert [r.d for r in rows.collect()] == ["1e18", "-1e300", "2262-04-11", "NaN", "Infinity"]


def test_csv_keeps_edges_and_drops_an_index(spark):
    path = work_path(spark, "csv")
    tb.write_csv(spark.createDataFrame([(0, "  lead trail  ", "x\n")], ["Unnamed: 0", "source", "target"]), path)
    for schema in (None, "source string, target string"):
        row = tb.read_csv(spark, path, schema).first()
        assert (row.source, row.target) == ("  lead trail  ", "x\n")


def test_csv_tells_null_from_empty(spark):
    path = work_path(spark, "csv")
    rows = [(1, None, "a"), (2, "", "b"), (3, "  x ", ""), (4, 'q"uo\nte', None), (5, '""', "\\N")]
    tb.write_csv(spark.createDataFrame(rows, "i int, t string, u string"), path)
    kept = tb.read_csv(spark, path, "i int, t string, u string", keep_empty=True)
    assert sorted(map(tuple, kept.collect())) == rows
    alike = tb.read_csv(spark, path, "i int, t string, u string").filter("i IN (1, 2)").collect()
    assert [r.t for r in alike] == [None, None]
