"""Session settings, lineage cutting and shared working folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession

# Settings the results or the skew handling rely on; all can be set on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where that costs one more exchange after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply SQL_SETTINGS to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "newsweave", cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A small single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="newsweave-")
        context.setCheckpointDir(folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), f"newsweave-{spark.sparkContext.applicationId}")


#: Folder, below the application's, of the innermost ``discarding`` block.
_scope: ContextVar[str] = ContextVar("scope", default="")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table one job writes and a later one reads."""
    return os.path.join(application_folder(spark), _scope.get(), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def discarding(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables cut within the block go when it ends; what is to stay is written by the function it gives."""
    outer = _scope.get()
    token = _scope.set(os.path.join(outer, f"scope-{uuid.uuid4().hex}"))

    def keep(df: DataFrame) -> DataFrame:
        inner = _scope.set(outer)
        try:
            return cut(df)
        finally:
            _scope.reset(inner)

    try:
        yield keep
    finally:
        folder = os.path.join(application_folder(spark), _scope.get())
        _scope.reset(token)
        _delete(spark, folder)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The lineage ends at reliable files, so lost executors cost no earlier round, and the next plan sees the
    measured size. (A checkpointed frame would carry the size estimate of its whole history on: over the
    rounds of a loop these products grow until planning takes longer than the work.)
    """
    spark = df.sparkSession
    path = work_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; frames returned earlier become unreadable."""
    _delete(spark, application_folder(spark))


def scalar(df: DataFrame, value: Column) -> Column:
    """One aggregate over ``df`` as a scalar subquery, so no ungrouped window or cross join is needed."""
    return df.agg(value).scalar()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
