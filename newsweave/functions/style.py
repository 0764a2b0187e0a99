"""Colours, shapes, sizes and hover text of the graph views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# View colours and shapes.
TYPE_COLORS = {
    "people": "#ffd700",
    "organizations": "#ff7f0e",
    "locations": "#9467bd",
    "political_events": "#7f7f7f",
    "political_parties": "#2ca02c",
    "institutions": "#1f77b4",
    "unknown": "#d62728",
}
SENTIMENT_COLORS = {"FRIENDLY": "green", "HOSTILE": "red", "NEUTRAL": "gray"}
SOURCE_SHAPES = {"us": "circle", "french": "triangle", "german": "square"}
OTHER_TYPE_COLOR = "#d3d3d3"
MATCH_COLOR = "#ff0000"


def choose(key: Column, table: Mapping[str, str], default: str) -> Column:
    """CASE over a fixed mapping."""
    result = F.lit(default)
    for name, value in table.items():
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def type_color(entity_type: Column) -> Column:
    return choose(entity_type, TYPE_COLORS, OTHER_TYPE_COLOR)


def sentiment_color(sentiment: Column, default: str = "gray") -> Column:
    return choose(sentiment, SENTIMENT_COLORS, default)


def source_shape(article_source: Column) -> Column:
    return choose(F.lower(article_source), SOURCE_SHAPES, "dot")


def matches(name: Column, term: str) -> Column:
    """Literal, case-insensitive containment; an empty term matches nothing."""
    return F.lower(name).contains(term.lower()) if term else F.lit(False)


def small_size(centrality: Column) -> Column:
    return 10 + 30 * centrality


def explorer_size(centrality: Column, matched: Column) -> Column:
    size = 10 + 100 * centrality
    return F.when(matched, size * 1.5).otherwise(size)


def client_size(centrality: Column) -> Column:
    return F.greatest(F.lit(10.0), 300 * centrality)


def two_places(value: Column) -> Column:
    return F.format_string("%.2f", value)


def hover(name: Column, entity_type: Column, incoming: Column, outgoing: Column, total: Column, community: Column | None = None) -> Column:
    lines = [F.concat(name, F.lit(" ("), entity_type, F.lit(")"))]
    if community is not None:
        lines.append(F.concat(F.lit("community "), community))
    lines += [F.concat(F.lit(f"{what} "), two_places(value)) for what, value in (("incoming", incoming), ("outgoing", outgoing), ("total", total))]
    return F.concat_ws("; ", *lines)


def edge_hover(source: Column, target: Column, relationship: Column, sentiment: Column, date: Column) -> Column:
    """What is not known is left out."""
    named = (("from", source), ("to", target), ("relationship", relationship), ("sentiment", sentiment), ("date", date.cast("string")))
    return F.concat_ws("; ", *[F.concat(F.lit(f"{name} "), value) for name, value in named])
