import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsweave.functions import dates as dx
from newsweave.functions import nested as nx
from newsweave.functions import style
from newsweave.functions import text as tx
from newsweave.functions import vectors as vx


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").repartition(3)
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_publisher(spark):
    urls = ["https://a.org:8080/x", "http://me:pw@A.org/x?y", "a.org/x", "//h/p", "https://a b/c d", None, "https://a.org?q=//z", ""]
    assert apply(spark, urls, tx.publisher) == ["a.org:8080", "me:pw@A.org", "", "h", "a b", None, "a.org", ""]


def test_word_counts_use_unicode_blanks(spark):
    texts = [None, "", "  ", "a b", "a\u0085b c\x1cd", "a​b"] + [chr(c).join("ab") for c in range(0x3001) if chr(c).isspace()]
    expected = [len(t.split()) if t is not None else None for t in texts]
    assert apply(spark, texts, tx.text_length) == expected
    assert apply(spark, texts, tx.word_count) == [n or 0 for n in expected]


def test_keywords_and_types_of_null_text(spark):
    texts = [None, "The ELECTION day", "nothing", "pollen", "An Interview and Analysis", "interview"]
    assert apply(spark, texts, tx.mentions_any) == [False, True, False, True, False, False]
    assert apply(spark, texts, tx.article_type) == ["other", "other", "other", "other", "analysis", "interview"]


def test_titles(spark):
    names = ["Mr. Smith", "Mr Smith", "Ann President Lee", "Prof. Dr. Lee", "Drake Bell", "Prime Minister  May ", "Mr.", "Émile Mr. X"]
    expected = ["Smith", "Smith", "Ann Lee", "Lee", "Drake Bell", "May", "Mr.", "Émile X"]
    assert apply(spark, names, tx.normalize_title) == expected


def test_json_block(spark):
    texts = ['x {"a": {"b": 1}} y {z} w', "none", "{\n}\n", None, "} {"]
    assert apply(spark, texts, tx.json_block) == ['{"a": {"b": 1}} y {z}', None, "{\n}", None, None]


def test_rate_limit(spark):
    messages = ["Rate Limit reached", "HTTP 429", "QUOTA gone", "timeout", None]
    assert apply(spark, messages, tx.is_rate_limit) == [True, True, True, False, False]


@pytest.mark.parametrize(
    ("moment", "expected"),
    [("2024-11-04 15:00:00", 0), ("2024-11-05 15:00:00", -1), ("2024-11-05 00:00:00", 0), ("2024-11-01 00:00:00", 4), (None, None)],
)
def test_days_until_rounds_down(spark, moment, expected):
    assert apply(spark, [moment], lambda c: dx.days_until(c.cast("timestamp"), dx.US_ELECTION)) == [expected]


def test_weekend_of_null_is_false(spark):
    values = ["2024-06-01 10:00:00", "2024-06-03 10:00:00", None, "rubbish"]
    assert apply(spark, values, lambda c: dx.is_weekend(dx.parse_lenient(c))) == [True, False, False, False]


def test_strict_parse_fails(spark):
    with pytest.raises(Exception):
        apply(spark, ["rubbish"], dx.parse_strict)


def test_request_dates(spark):
    values = ["1730764800000", "2024-07-07", None, "1730764800000.7", "soon"]
    assert apply(spark, values, dx.request_date) == ["2024-11-05", "2024-07-07", None, "2024-11-05", "soon"]


def test_nested_cells(spark):
    maps = ['{"people": ["A", "B"], "places": "x"}', "[1]", "{bad", None, "{'people': ['A']}"]
    assert apply(spark, maps, nx.entity_lists) == [{"people": ["A", "B"], "places": None}, {}, {}, {}, {"people": ["A"]}]
    lists = ['[17, {"source": "a", "target": null}]', "{}", "[", None]
    assert apply(spark, lists, nx.relationship_maps) == [[{}, {"source": "a", "target": None}], [], [], []]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    found = [r[0] for r in df.select(vx.cosine(F.col("a"), F.col("b"))).collect()]
    assert found == pytest.approx([2**-0.5, 0.0])


def test_style(spark):
    assert apply(spark, ["people", "else", None], style.type_color) == ["#ffd700", "#d3d3d3", "#d3d3d3"]
    assert apply(spark, ["US", "x"], style.source_shape) == ["circle", "dot"]
    assert apply(spark, [0.5, 0.001], style.client_size, "double") == [150.0, 10.0]
    assert apply(spark, ["supports it"], lambda c: tx.menu_label(c, F.lit("FRIENDLY"))) == ["Supports It / Friendly"]


def test_epoch_of_fixture_start():
    assert dt.datetime.fromtimestamp(1717200000, dt.UTC).isoformat() == "2024-06-01T00:00:00+00:00"
