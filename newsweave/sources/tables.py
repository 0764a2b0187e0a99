"""Readers and writers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX_NAMES = ("", "_c0", "Unnamed: 0")
EMPTY = "\ue000"  # a private-use character stands for the quoted empty cell while reading
CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("relationship", T.StringType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("entity", T.StringType()),
        T.StructField("entity_type", T.StringType()),
    ]
)


def load_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, with an optional projection that reaches the scan."""
    table = spark.read.table(name)
    return table.select(*columns) if columns else table


def load_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def spread(scan: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has fewer partitions than there are cores; others pass unchanged."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, keep_empty: bool = False) -> DataFrame:
    """CSV with a header whose quoted cells may hold line breaks; any path Spark's file systems can open.

    Without a schema the column types are inferred, which reads the data twice. A first column with a blank
    name is a row index some writer added, and is dropped. Empty cells are null, quoted or not, unless ``keep_empty`` makes
    the quoted ones empty strings, as ``write_csv`` writes them.
    """
    if keep_empty:
        df = _read_csv(spark.read.options(**CSV_OPTIONS, emptyValue=EMPTY), path, schema)
        strings = {f.name: F.when(F.col(f"`{f.name}`") == EMPTY, F.lit("")).otherwise(F.col(f"`{f.name}`")) for f in df.schema if f.dataType == T.StringType()}
        return df.withColumns(strings)
    return _read_csv(spark.read.options(**CSV_OPTIONS), path, schema)


def _read_csv(reader: DataFrameReader, path: str, schema: T.StructType | str | None) -> DataFrame:
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
        return df.drop(df.columns[0]) if df.columns[0].strip() in INDEX_NAMES else df
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    first = reader.csv(path).columns[0]  # from the header alone
    if first.strip() not in INDEX_NAMES or first in fields.names:
        return reader.schema(fields).csv(path)
    return reader.schema(T.StructType([T.StructField(first, T.StringType()), *fields])).csv(path).drop(first)


def write_csv(df: DataFrame, path: str) -> None:
    """White space at the edges of cells is kept; a null is a blank cell, an empty string a quoted one."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', **keep).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_results(df: DataFrame, path: str) -> None:
    """Append a batch of rows to a result table."""
    df.write.mode("append").parquet(path)


def snapshot(df: DataFrame, path: str, stamp: str) -> None:
    """Keep a stamped copy of the batch; writing one stamp again replaces that stamp only."""
    if not re.fullmatch(r"[\w\-]+", stamp):
        raise ValueError("a stamp holds letters, digits, _ and - only")
    df.write.mode("overwrite").parquet(f"{path}/batch_stamp={stamp}")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def to_documents(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("document"))


def flag_source(df: DataFrame, flags: Mapping[str, int]) -> DataFrame:
    """Constant 0/1 columns telling which source table a row came from."""
    return df.withColumns({name: F.lit(value) for name, value in flags.items()})


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Concatenate tables, aligning columns by name."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def default_column(df: DataFrame, name: str, value: object) -> DataFrame:
    """Add a constant column only where the table lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(value))
