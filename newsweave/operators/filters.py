"""Row filters and column clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsweave.functions import text as tx

ALL = "All"


def clean_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to text and trim both sides."""
    return df.withColumns({c: tx.strip(F.col(c).cast("string")) for c in columns})


def lower_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.lower(F.col(column).cast("string")))


def language_is(df: DataFrame, language: str = "en") -> DataFrame:
    return df.filter(F.col("language") == language)


def relevant_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("relevance_text") == 1)


def label_queue(df: DataFrame, label: str = "relevance_text") -> DataFrame:
    """Rows still waiting for a label."""
    return df.filter(F.col(label).isNull())


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def nonblank_text(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(~tx.is_blank(F.col(column)))


def nonempty(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows whose list or map columns all hold at least one element."""
    for column in columns:
        df = df.filter(F.size(column) > 0)
    return df


def equals_or_all(df: DataFrame, column: str, wanted: str = ALL) -> DataFrame:
    """Exact match, or everything for ``All``."""
    return df if wanted == ALL else df.filter(F.col(column) == wanted)


def date_range(df: DataFrame, start: str | None = None, end: str | None = None, column: str = "date") -> DataFrame:
    """Inclusive range, applied only when both ends are given."""
    if not (start and end):
        return df
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def search_edges(df: DataFrame, term: str, direction: str = "all", mode: str = "regex") -> DataFrame:
    """Keep edges whose target (incoming), source (outgoing) or either end matches the lower-cased term."""
    if not term:
        return df

    def hit(column: str) -> Column:
        lowered = F.lower(column)
        return lowered.rlike(term.lower()) if mode == "regex" else lowered.contains(term.lower())

    if direction == "incoming":
        return df.filter(hit("target"))
    if direction == "outgoing":
        return df.filter(hit("source"))
    return df.filter(hit("source") | hit("target"))


def from_source(df: DataFrame, article_source: str | Sequence[str] = "") -> DataFrame:
    """Case-insensitive match on the article source, one value or several; empty or ``all`` keeps everything."""
    wanted = [article_source] if isinstance(article_source, str) else list(article_source)
    wanted = [value.lower() for value in wanted if value]
    if not wanted or "all" in wanted:
        return df
    return df.filter(F.lower("article_source").isin(wanted))


def drop_self_loops(df: DataFrame) -> DataFrame:
    """Both ends present and different; a null end fails the comparison."""
    return df.filter(F.col("source") != F.col("target"))


def nodes_by_property(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Nodes whose property is in the list."""
    return df.filter(F.col(column).cast("string").isin(list(values)))


def endpoints_by_property(edges: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct ends of the edges whose property is in the list."""
    kept = nodes_by_property(edges, column, values)
    return kept.select(F.explode(F.array("source", "target")).alias("node")).distinct()
