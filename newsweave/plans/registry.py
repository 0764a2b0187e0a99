"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsweave.plans import article_queries, edge_queries, extraction_queries, name_queries, score_queries
from newsweave.session import tune

FAMILIES = [article_queries, edge_queries, extraction_queries, name_queries, score_queries]


def _tuned(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _tuned(query) for family in FAMILIES for name, query in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
